"""Apply a profile: raw columns to numeric features, dense or sparse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vectorloom.functions import numeric as fn
from vectorloom.operators.lookup import Size, fits_broadcast, lookup_join
from vectorloom.operators.profile import Profile, fit_profile, nominal_values, typed_column
from vectorloom.plans.spec import ColumnSpec, FeatureSpec, Kind, Transform
from vectorloom.session import materialize

UNSEEN_POLICIES = ("error", "null", "minus_one")


def _numeric_feature(x: Column, column: ColumnSpec, profile: Profile) -> Column:
    stats = profile.by_column[column.name]
    match column.transform:
        case Transform.BINARIZE:
            return fn.binarize(x, F.lit(stats.low), F.lit(stats.high))
        case Transform.NORMALIZE:
            return fn.normalize(x, F.lit(stats.low), F.lit(stats.high))
        case Transform.ZEROMEAN_ZEROUNITVARIANCE:
            return fn.standardize(x, F.lit(stats.avg), F.lit(stats.stddev))
        case _:
            return fn.copy(x)


def _nominal_feature(value: Column, label_id: Column, column: ColumnSpec, profile: Profile, unseen: str) -> Column:
    if column.transform in (Transform.NORMALIZE, Transform.ZEROMEAN_ZEROUNITVARIANCE):
        known = fn.normalize_label(label_id, max(profile.n_labels(column.name), 1))
    else:
        known = fn.copy(label_id)
    if unseen == "error":
        message = F.concat(F.lit(f"unseen label in {column.name}: "), value)
        missing = F.raise_error(message).cast("double")
    else:
        missing = F.lit(-1.0 if unseen == "minus_one" else None).cast("double")
    return F.when(label_id.isNotNull(), known).when(value.isNotNull(), missing)


def apply_profile(df: DataFrame, profile: Profile, unseen: str = "error", keep: tuple[str, ...] = ()) -> DataFrame:
    """Replace every non-SKIP spec column by its numeric feature, label included.

    ``unseen`` says what a category missing from the dictionary becomes. ``keep``
    columns pass through unchanged. Only a dictionary join can shuffle, and only
    when the dictionary is too large to broadcast.
    """
    if unseen not in UNSEEN_POLICIES:
        raise ValueError(f"unseen must be one of {UNSEEN_POLICIES}")
    emitted = profile.spec.emitted
    both = sorted({c.name for c in emitted} & set(keep))
    if both:
        raise ValueError(f"columns both kept and transformed: {both}")
    out = df.select(
        *[F.col(f"`{k}`").alias(f"keep_{k}") for k in keep],
        *[typed_column(df, c).alias(f"raw_{c.name}") for c in emitted],
    )
    sizes = {c: profile.labels.sizes.get(c.name, Size(0, 0)) for c in emitted if c.kind is Kind.NOMINAL}
    # smallest first: after the first dictionary that needs a shuffle, the rows are worth writing;
    # all broadcast dictionaries together stay within the threshold for one
    shuffled, broadcast_bytes = False, 0
    for c, size in sorted(sizes.items(), key=lambda item: item[1].bytes):
        ids = profile.labels.of(c.name).select(
            F.col("label").alias(f"raw_{c.name}"), F.col("label_id").alias(f"id_{c.name}")
        )
        broadcast_bytes += size.bytes
        fits = fits_broadcast(df.sparkSession, Size(size.rows, broadcast_bytes))
        out = lookup_join(out, ids, f"raw_{c.name}", size=size, costly=shuffled, may_broadcast=fits)
        shuffled = shuffled or not fits
    features = [
        _nominal_feature(F.col(f"`raw_{c.name}`"), F.col(f"`id_{c.name}`"), c, profile, unseen)
        if c.kind is Kind.NOMINAL
        else _numeric_feature(F.col(f"`raw_{c.name}`"), c, profile)
        for c in emitted
    ]
    return out.select(
        *[F.col(f"`keep_{k}`").alias(k) for k in keep],
        *[f.alias(c.name) for f, c in zip(features, emitted)],
    )


def assemble_plain(df: DataFrame, spec: FeatureSpec, keep: tuple[str, ...] = ()) -> DataFrame:
    """``features`` array in spec order, and ``label`` (0.0 when the spec has none)."""
    label = F.col(f"`{spec.label.name}`") if spec.label else F.lit(0.0)
    features = [F.col(f"`{c.name}`") for c in spec.features]
    return df.select(*keep, F.array(*features).alias("features"), label.alias("label"))


def sparse_indices(spec: FeatureSpec, compat: bool = False) -> list[int]:
    """1-based index of every feature; ``compat`` leaves a gap where the label stands."""
    if not compat:
        return list(range(1, len(spec.features) + 1))
    names = [c.name for c in spec.emitted]
    return [names.index(c.name) + 1 for c in spec.features]


def sparse_entries(spec: FeatureSpec, compat: bool = False) -> Column:
    """Array of (index, value) without zero values; with ``compat`` without negatives too."""
    entries = [
        F.struct(F.lit(i).alias("index"), F.col(f"`{c.name}`").alias("value"))
        for i, c in zip(sparse_indices(spec, compat), spec.features)
    ]
    wanted = (lambda e: e["value"] > 0) if compat else (lambda e: e["value"] != 0)
    return F.filter(F.array(*entries), wanted)


def assemble_sparse(df: DataFrame, spec: FeatureSpec, compat: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """``label`` and ``entries`` (see ``sparse_entries``)."""
    label = F.col(f"`{spec.label.name}`") if spec.label else F.lit(0.0)
    return df.select(*keep, label.alias("label"), sparse_entries(spec, compat).alias("entries"))


def vectorize(
    df: DataFrame, spec: FeatureSpec, position: list[str], keep: tuple[str, ...] = (), costly: bool = False
) -> DataFrame:
    """Profile, apply and assemble in one call.

    The input is read three times. With ``costly`` (text that has to be parsed, say) its
    typed values are written once and the three scans read those, by column.
    """
    if costly:
        typed = [typed_column(df, c).alias(c.name) for c in spec.columns]
        places = [F.col(p).alias(f"__at_{i}") for i, p in enumerate(position)]
        df = materialize(df.select(*keep, *places, *typed), "typed")
        position = [f"__at_{i}" for i in range(len(position))]
    profile = fit_profile(df, spec, position)
    return assemble_plain(apply_profile(df, profile, keep=keep), spec, keep)


def unseen_label_audit(df: DataFrame, profile: Profile) -> DataFrame:
    """Per NOMINAL column: values, and values whose label the dictionary lacks."""
    counts = (
        df.select(nominal_values(df, profile.spec.nominal))
        .filter(F.col("label").isNotNull())
        .groupBy("column_name", "label")
        .agg(F.count("*").alias("seen"))
    )
    # counts are distinct per (column, label), so neither side of this join has a hot key
    known = profile.labels.rows.select("column_name", "label", F.lit(True).alias("known"))
    return (
        counts.join(known, ["column_name", "label"], "left")
        .groupBy("column_name")
        .agg(
            F.sum("seen").alias("n_values"),
            F.sum(F.when(F.col("known").isNull(), F.col("seen")).otherwise(0)).alias("n_missed"),
            F.count_if(F.col("known").isNull()).alias("n_missed_labels"),
        )
    )
