"""One scoring chain for training, batch tables and streams, with all state fitted on train."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from pyspark.ml import Estimator, Model
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.encode import EncoderState, encode_train_test
from ..operators.features import engineer
from ..operators.isotonic import IsotonicMap
from ..operators.models import (
    SCORE,
    Operating,
    assemble,
    boosted,
    fit_operating,
    hold_out,
    positive_score,
    train_centers,
    with_pos_weight,
)
from ..operators.quality import align_schema, require_model_ready
from ..operators.scale import ScalerState, columns_to_scale, fit_scaler
from ..operators.split import TimePlan
from ..schema import Roles
from ..session import stage

ABSENT_LABEL = "_no_label"


@dataclass
class BookingScorer:
    roles: Roles
    encoders: EncoderState
    scaler: ScalerState
    features: list[str]
    model: Model
    centers: dict[str, float] = field(default_factory=dict)  # train means, for explanations
    operating: Operating | None = None

    def feature_rows(self, df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
        """Raw bookings as the model's columns: engineered, encoded, scaled and aligned.

        A missing number counts as the train center, which is 0 after scaling.
        """
        kept = {f"_keep_{c}": F.col(c) for c in keep}
        coded = self.encoders.apply(engineer(df.withColumns(kept) if kept else df, self.roles))
        scaled = self.scaler.apply(coded)
        aligned = align_schema(scaled, [*kept, *self.features]).fillna(0, self.features)
        return aligned.withColumnsRenamed({k: k.removeprefix("_keep_") for k in kept})

    def transform(
        self, df: DataFrame, keep: tuple[str, ...] = (), calibrated: bool = False
    ) -> DataFrame:
        """Add the cancellation probability `p`; works on tables and on streams.

        `calibrated` adds `p_calibrated` by the map that is saved with the model.
        """
        rows = self.feature_rows(df, keep).withColumn(ABSENT_LABEL, F.lit(None).cast("double"))
        scored = positive_score(self.model, assemble(rows, self.features, ABSENT_LABEL, keep))
        out = scored.select(*keep, SCORE)
        return self.operating.calibration.apply(out, SCORE, "p_calibrated") if calibrated else out

    def save(self, path: str) -> None:
        spark = self.encoders.frequency.sparkSession
        self.encoders.frequency.write.mode("overwrite").parquet(f"{path}/frequency")
        self.encoders.target_means.write.mode("overwrite").parquet(f"{path}/target_means")
        self.scaler.table(spark).write.mode("overwrite").parquet(f"{path}/scaler")
        self.model.write().overwrite().save(f"{path}/model")
        small = {
            "roles": asdict(self.roles),
            "prior": self.encoders.prior,
            "levels": self.encoders.levels,
            "high_card": self.encoders.high_card,
            "drop_after": self.encoders.drop_after,
            "scaler_kind": self.scaler.kind,
            "features": self.features,
            "centers": self.centers,
            "threshold": self.operating.threshold if self.operating else None,
            "calibrated": self.operating is not None,
        }
        if self.operating:
            self.operating.calibration.save(f"{path}/calibration")
        row = spark.createDataFrame([(json.dumps(small),)], "value string").coalesce(1)
        row.write.mode("overwrite").text(f"{path}/settings")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BookingScorer:
        small = json.loads(spark.read.text(f"{path}/settings").first()[0])
        roles = {k: tuple(v) if isinstance(v, list) else v for k, v in small["roles"].items()}
        encoders = EncoderState(
            spark.read.parquet(f"{path}/frequency"),
            spark.read.parquet(f"{path}/target_means"),
            small["prior"],
            small["levels"],
            small["high_card"],
            small["drop_after"],
        )
        rows = spark.read.parquet(f"{path}/scaler").collect()  # one row per column
        scaler = ScalerState(
            small["scaler_kind"],
            tuple(r["feature"] for r in rows),
            {r["feature"]: r["center"] for r in rows},
            {r["feature"]: r["scale"] for r in rows},
        )
        model = DefaultParamsReader.loadParamsInstance(f"{path}/model", spark)
        operating = None
        if small.get("calibrated"):
            operating = Operating(small["threshold"], IsotonicMap.load(spark, f"{path}/calibration"))
        return cls(
            Roles(**roles), encoders, scaler, small["features"], model, small.get("centers", {}), operating
        )


@dataclass
class PreparedTables:
    """Staged feature tables with the state that made them."""

    train: DataFrame
    test: DataFrame
    encoders: EncoderState
    scaler: ScalerState
    features: list[str]


def prepare_tables(
    train: DataFrame,
    test: DataFrame,
    roles: Roles = Roles(),
    carry: tuple[str, ...] = ("period",),
    scaler_kind: str = "robust",
) -> PreparedTables:
    """Engineer, encode and scale both sides; every statistic comes from train."""
    train_f = stage(engineer(train, roles), "train-featured")
    test_f = stage(engineer(test, roles), "test-featured")
    train_e, test_e, encoders = encode_train_test(train_f, test_f, roles)
    train_e = stage(train_e, "train-encoded")
    test_e = stage(test_e, "test-encoded")
    not_features = {roles.id, roles.target, *carry}
    features = [c for c in train_e.columns if c not in not_features]
    require_model_ready(train_e.select(*features), test_e.select(*features))
    scaler = fit_scaler(
        train_e, columns_to_scale(train_e, roles.target, skip=list(not_features)), scaler_kind
    )
    train_s, test_s = (scaler.apply(side).fillna(0, features) for side in (train_e, test_e))
    return PreparedTables(train_s, test_s, encoders, scaler, features)


def fit_scorer(
    tables: PreparedTables,
    roles: Roles = Roles(),
    make: Callable[[], Estimator] = boosted,
    plan: TimePlan | None = None,
) -> BookingScorer:
    """Fit on all train rows. With a `plan`, threshold and calibration come from its last fold."""
    train = tables.train.where(F.col(roles.target).isNotNull())
    model = make().fit(with_pos_weight(assemble(train, tables.features, roles.target)))
    operating = None
    if plan:
        operating = fit_operating(hold_out(train, plan, tables.features, roles.target, make))
    centers = train_centers(train, tables.features)
    return BookingScorer(
        roles, tables.encoders, tables.scaler, tables.features, model, centers, operating
    )
