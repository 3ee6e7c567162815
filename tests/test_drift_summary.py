"""The summary's window is the shifted one, as its report's."""

import __spark_entry__ as entry_point


def test_summary_is_that_of_the_shifted_window(spark, sf_dir):
    queries = entry_point.queries()
    report = queries["drift_injected"](spark, sf_dir).collect()
    summary = queries["drift_summary"](spark, sf_dir).first()
    ranked = sorted(report, key=lambda r: (-r.psi, r.feature))
    assert summary.overall_drift == "significant_drift"
    assert summary.n_significant == sum(r.drift == "significant_drift" for r in report)
    assert summary.max_psi == ranked[0].psi
    assert summary.top_drifted == ",".join(r.feature for r in ranked[:5])
