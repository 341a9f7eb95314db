"""Cleaning operators over shipment tables: DataFrame in, DataFrame out."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..session import Steps, if_small, materialize

# -- dates --------------------------------------------------------------------


def repair_years(df: DataFrame, actual: str = "arrival_date_actual", estimate: str = "arrival_date_estimate", month: str = "report_month", gap: int = 360) -> DataFrame:
    """Dates whose year is off by more than one from the report's, and more than
    ``gap`` days from the other date, take the other's year; the estimate is
    judged against the repaired actual date."""
    a, e, y = F.col(actual), F.col(estimate), F.year(month)

    def off(c, other):
        return (F.abs(F.year(c) - y) > 1) & (F.abs(F.date_diff(c, other)) > gap)

    df = df.withColumn(actual, F.when(off(a, e), X.with_year(a, F.year(e))).otherwise(a))
    return df.withColumn(estimate, F.when(off(e, a), X.with_year(e, F.year(a))).otherwise(e))


def repair_delay(df: DataFrame, actual: str = "arrival_date_actual", estimate: str = "arrival_date_estimate", delay: str = "arrival_date_delay", gap: int = 300) -> DataFrame:
    """Delay in days; estimates more than ``gap`` days off move by a year: first
    around the turn of the year, then wherever they are still off (late ones
    first)."""
    a, e, d = F.col(actual), F.col(estimate), F.col(delay)
    near = F.month(a).isin(1, 2, 3) | F.month(e).isin(1, 2)

    def moved(df: DataFrame, where, months: int) -> DataFrame:
        df = df.withColumn(estimate, F.when(where, F.add_months(e, months)).otherwise(e))
        return df.withColumn(delay, F.date_diff(a, e))

    df = df.withColumn(delay, F.date_diff(a, e))
    shift = F.when((d < -gap) & near, -12).when((d > gap) & near, 12)
    df = df.withColumn(estimate, F.when(shift.isNotNull(), F.add_months(e, shift)).otherwise(e)).withColumn(delay, F.date_diff(a, e))
    df = moved(df, d > gap, 12)
    return moved(df, d < -gap, -12)


# -- lists, codes, descriptions -----------------------------------------------


def normalise_lists(df: DataFrame, columns: Sequence[str], separator: str = ", ") -> DataFrame:
    return df.withColumns({c: X.listed(c, separator) for c in columns})


def split_column(df: DataFrame, column: str, first: str, second: str, pattern: str, fill: str | None = None, keep: bool = False, trimmed: bool = True) -> DataFrame:
    a, b = X.split_in_two(column, pattern, trimmed)
    fill_in = lambda c: F.coalesce(c, F.lit(fill)) if fill is not None else c
    df = df.withColumns({"_first": fill_in(a), "_second": fill_in(b)})
    df = df if keep else df.drop(column)
    return df.drop(*(c for c in (first, second) if c in df.columns)).withColumnsRenamed({"_first": first, "_second": second})


def clean_description(df: DataFrame, column: str = "product_desc") -> DataFrame:
    return df.withColumn(column, X.untagged(X.printable(column)))


def enrich_hscodes(df: DataFrame, hscodes: DataFrame, column: str = "hscode", cargo_count: bool = True) -> DataFrame:
    """Normalised code list, its length, prefixes and descriptions. Headings that the
    table lacks take the last heading of their chapter's range."""
    df = df.withColumn(column, X.listed(column, ","))
    if cargo_count:
        df = df.withColumn("cargo_count", F.when(F.col(column).isNotNull(), F.size(F.split(column, ","))).cast("double"))
    df = df.withColumn("hscode_02", F.substring(column, 1, 2)).withColumn("hscode_04", F.substring(column, 1, 4))
    df = df.drop("hscode_02_desc_short", "hscode_04_desc_short")
    heads = hscodes.groupBy("hscode_04").agg(F.min("hscode_02_desc_short").alias("d2"), F.min("hscode_04_desc_short").alias("d4"))
    last = hscodes.select(F.split_part("hscode_02_range", F.lit(" "), F.lit(3)).alias("last")).distinct()
    chapters = heads.join(last, heads["hscode_04"] == last["last"]).groupBy(F.substring("last", 1, 2).alias("hscode_02")).agg(F.max_by("d2", "last").alias("f2"), F.max_by("d4", "last").alias("f4"))
    out = df.join(if_small(heads), "hscode_04", "left").join(if_small(chapters), "hscode_02", "left")
    missing = F.col("d2").isNull()
    return out.withColumn("hscode_02_desc_short", F.when(missing, F.col("f2")).otherwise(F.col("d2"))).withColumn("hscode_04_desc_short", F.when(missing, F.col("f4")).otherwise(F.col("d4"))).drop("d2", "d4", "f2", "f4")


def enrich_ports(df: DataFrame, ports: DataFrame, port: str, key: str = "port_code", columns: Sequence[str] = ("lat", "lon", "country", "continent")) -> DataFrame:
    """Adds the port table's columns as ``{port}_{column}``; one row for each code."""
    one = ports.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias(f"{port}_code")).agg(*(F.min_by(c, F.struct(*(F.col(x).isNull() for x in columns), *columns)).alias(f"{port}_{c}") for c in columns))
    named = [f"{port}_{c}" for c in columns]
    return df.drop(*named).join(if_small(one), f"{port}_code", "left")


# -- vessels ------------------------------------------------------------------


def fill_each_other(df: DataFrame, imo: str = "vessel_imo", name: str = "vessel_name") -> DataFrame:
    """The name's IMO where it is missing, then the IMO's name. The value taken is
    the least; a missing key gives nothing. Lookups are aggregates joined back, written
    first, so that those that are small are broadcast and rows of frequent names stay where they are."""
    by_name = if_small(materialize(df.filter(f"{name} is not null and {imo} is not null").groupBy(name).agg(F.min(imo).alias("_i")), "by_name"))
    df = df.join(by_name, name, "left").withColumn(imo, F.coalesce(imo, "_i")).drop("_i")
    by_imo = if_small(materialize(df.filter(f"{name} is not null and {imo} is not null").groupBy(imo).agg(F.min(name).alias("_n")), "by_imo"))
    return df.join(by_imo, imo, "left").withColumn(name, F.coalesce(name, "_n")).drop("_n")


def clean_vessel_keys(df: DataFrame, code: str = "vessel_code", name: str = "vessel_name", mode: str = "mode_of_transportation") -> DataFrame:
    """Vessel type from the mode, codes that are numbers, names that are not."""
    df = df.withColumn("vessel_type", X.vessel_type_of(mode))
    return df.withColumn("vessel_imo", F.when(X.valid_int(code), F.col(code).cast("string"))).withColumn(name, F.when(~X.valid_int(name), F.upper(F.trim(name))))


def unique_registry(registry: DataFrame, name: str = "vessel_name", imo: str = "vessel_imo") -> DataFrame:
    """One row for each name and each IMO, so that joins don't multiply rows."""
    rows = registry.filter(f"{name} is not null and {imo} is not null")
    rest = [c for c in rows.columns if c not in (name, imo)]
    one = rows.groupBy(name).agg(F.min(F.struct(imo, *rest)).alias("r")).select(name, "r.*")
    return one.groupBy(imo).agg(F.min(F.struct(name, *rest)).alias("r")).select(imo, "r.*")


def standardise_vessels(df: DataFrame, registry: DataFrame, imo: str = "vessel_imo", name: str = "vessel_name", kind: str = "vessel_type", originals: bool = False, scores: bool = True, fuzzy: bool = True) -> DataFrame:
    """Names and types from the registry: by IMO (score 100), else (``fuzzy``) by the best
    match of the name in two rounds. What matches nothing keeps its own name and type."""
    from .matching import match_names

    known = unique_registry(registry, name, imo)
    bol = {imo: "vessel_imo_bol", name: "vessel_name_bol", kind: "vessel_type_bol"}
    df = fill_each_other(df, imo, name).withColumnsRenamed(bol)
    known = materialize(known, "registry")
    v = known.select(F.col(imo).alias("_imo"), F.col(name).alias("_name"), F.col(kind).alias("_kind"))
    joined = df.join(if_small(v), F.col("vessel_imo_bol") == F.col("_imo"), "left")
    lost = joined.filter("_imo is null and vessel_name_bol is not null").select(F.col("vessel_name_bol").alias(name)).distinct()
    found = match_names(lost, known.select(name), name) if fuzzy else lost.limit(0).select(name, F.lit("").alias("match"), F.lit(0).alias("score"))
    table = found.join(v, found["match"] == v["_name"]).select(F.col(name).alias("_lost"), F.col("_imo").alias("_imo2"), F.col("_name").alias("_name2"), F.col("_kind").alias("_kind2"), "score")
    out = joined.join(if_small(materialize(table, "vessels")), F.col("_imo").isNull() & (F.col("vessel_name_bol") == F.col("_lost")), "left")
    out = out.withColumn("match_score", F.when(F.col("_imo").isNotNull(), 100).otherwise(F.coalesce("score", F.lit(0))).cast("int"))
    out = out.withColumn(imo, F.coalesce("_imo", "_imo2"))
    out = out.withColumn(name, F.upper(X.digits_to_null(F.coalesce("_name", "_name2", "vessel_name_bol"))))
    out = out.withColumn(kind, X.digits_to_null(F.coalesce("_kind", "_kind2", "vessel_type_bol")))
    out = out.drop("_imo", "_name", "_kind", "_lost", "_imo2", "_name2", "_kind2", "score")
    out = out if originals else out.drop(*bol.values())
    return out if scores else out.drop("match_score")


# -- outliers -----------------------------------------------------------------


#: Values of a column that the search for a quantile may bring to the driver.
QUANTILE_VALUES = 10_000
#: Size of the sketches that enclose quantiles, and the share of ranks given on both sides.
SKETCH_SIZE, SKETCH_ROOM = 4096, 0.003


def _sketched(values: DataFrame, n: int) -> list[dict]:
    """Per column of ``values`` (v0, v1, ...): its count, ends and a mergeable sketch, in one pass."""
    stats = lambda v: F.struct(F.count(v).alias("n"), F.min(v).alias("least"), F.max(v).alias("most"), F.kll_sketch_agg_double(v, SKETCH_SIZE).alias("sketch"))
    return list(values.agg(*(stats(F.col(f"v{i}")).alias(f"v{i}") for i in range(n))).first())


def _near(values: DataFrame, ends: dict[int, tuple[float, float]]) -> DataFrame:
    """Counts of the values between the ends of each column, and (as null) of those above."""
    rows = F.array(*(F.when(F.col(f"v{i}") >= low, F.struct(F.lit(i).alias("i"), F.when(F.col(f"v{i}") <= high, F.col(f"v{i}")).alias("v"))) for i, (low, high) in ends.items()))
    return values.select(F.explode(F.array_compact(rows)).alias("x")).groupBy("x.i", "x.v").agg(F.count("*").alias("n"))


def _at_place(near: DataFrame, skipped: int, place: int) -> tuple[float, float | None]:
    """The values at ``place`` and after it, of a table of values with counts that ``skipped`` lesser ones precede."""
    while (kinds := near.count()) > QUANTILE_VALUES:
        sketch = near.agg(F.kll_sketch_agg_double("v", 200).alias("s"))
        cuts = sorted({float("inf"), *sketch.select(*(F.kll_sketch_get_quantile_double("s", F.lit(k / 32)) for k in range(1, 32))).first()})
        part = near.withColumn("part", sum((F.col("v") > c).cast("int") for c in cuts))
        sizes = {r["part"]: r["n"] for r in part.groupBy("part").agg(F.sum("n").alias("n")).collect()}  # a row for each cut
        keep, before = set(), skipped
        for k in sorted(sizes):
            if before <= place + 1 and before + sizes[k] > place:
                keep.add(k)
            elif k < min(keep, default=len(cuts)):
                skipped += sizes[k]
            before += sizes[k]
        near = materialize(part.filter(F.col("part").isin(*keep)).drop("part"), "near")
        if near.count() >= kinds:
            raise RuntimeError("the search for a quantile does not get on")
    at, found = skipped, None
    for r in near.orderBy("v").collect():  # QUANTILE_VALUES at most
        at += r["n"]
        if found is None and at > place:
            found = r["v"]
        if at > place + 1:
            return found, r["v"]
    return found, None


def quantiles_and_ends(df: DataFrame, columns: Sequence[str], share: float) -> dict[str, tuple[float | None, float | None]]:
    """Exact quantiles of whole columns (linear interpolation) and their greatest values.

    The columns are written once. One pass over them sketches all columns, whose
    quantiles at ranks a little below and above the place enclose the quantile; a
    second counts what lies between. Only these few values are looked at further.
    If a sketch missed, the ends move apart and the second pass runs again. No task
    ever holds a column. NaN counts as null; infinities are values like others (between
    -inf and a number the quantile is -inf); both are null for a column without values.
    """
    if not columns:
        return {}
    numbers = [F.col(c).cast("double") for c in columns]
    steps = Steps(df.sparkSession)
    values = steps.write(df.select(*(F.when(~F.isnan(x), x).alias(f"v{i}") for i, x in enumerate(numbers))), "values")
    rows = _sketched(values, len(columns))
    found: dict[int, float] = {}
    open_ = {i: (r["n"] - 1) * share for i, r in enumerate(rows) if r["n"]}
    room = SKETCH_ROOM
    while open_:
        asked = {i: (place / rows[i]["n"] - room, (place + 2) / rows[i]["n"] + room) for i, place in open_.items()}
        sketches = df.sparkSession.createDataFrame([tuple(rows[i]["sketch"] for i in open_)], ", ".join(f"s{i} binary" for i in open_))
        at = sketches.select(*(F.kll_sketch_get_quantile_double(f"s{i}", F.lit(min(1.0, max(0.0, x)))) for i in open_ for x in asked[i])).first()
        ends = {i: (at[2 * k] if asked[i][0] > 0 else rows[i]["least"], at[2 * k + 1] if asked[i][1] < 1 else rows[i]["most"]) for k, i in enumerate(open_)}
        near = steps.write(_near(values, ends), "near-values")
        sums = {(r["i"], r["above"]): r["n"] for r in near.groupBy("i", F.col("v").isNull().alias("above")).agg(F.sum("n").alias("n")).collect()}  # two rows for each column
        for i, place in list(open_.items()):
            n, inside, above = rows[i]["n"], sums.get((i, False), 0), sums.get((i, True), 0)
            skipped, whole = n - inside - above, int(place)
            if skipped <= whole and min(whole + 2, n) <= skipped + inside:
                x, after = _at_place(near.filter((F.col("i") == i) & F.col("v").isNotNull()).select("v", "n"), skipped, whole)
                part = place - whole
                found[i] = x if not part or after is None or after == x or x == -math.inf else x + (after - x) * part
                del open_[i]
        room *= 4
    steps.drop("values", "near-values")
    return {c: (found.get(i), rows[i]["most"]) for i, c in enumerate(columns)}


def quantiles(df: DataFrame, columns: Sequence[str], share: float) -> dict[str, float | None]:
    """Exact quantiles of whole columns, see ``quantiles_and_ends``."""
    return {c: q for c, (q, _) in quantiles_and_ends(df, columns, share).items()}


def quantile_limits(df: DataFrame, columns: Sequence[str], threshold: float = 0.99) -> dict[str, float | None]:
    """Exact upper quantiles, one for each column; null where no value lies above it."""
    return {c: q if q is not None and most > q else None for c, (q, most) in quantiles_and_ends(df, columns, threshold).items()}


def quantile_mask(df: DataFrame, columns: Sequence[str], threshold: float = 0.99) -> tuple[DataFrame, dict[str, float | None]]:
    """Adds ``{column}_outlier`` for columns that have any."""
    limits = quantile_limits(df, columns, threshold)
    return df.withColumns({f"{c}_outlier": F.coalesce(F.col(c) > q, F.lit(False)) for c, q in limits.items() if q is not None}), limits


def zscore_mask(df: DataFrame, columns: Sequence[str], sigma: float = 3) -> DataFrame:
    stats = df.agg(*(F.avg(c).alias(f"_m_{c}") for c in columns), *(F.stddev_samp(c).alias(f"_s_{c}") for c in columns))
    out = df.crossJoin(F.broadcast(stats))  # a single row
    masks = {f"{c}_outlier": F.coalesce(F.abs(F.col(c) - F.col(f"_m_{c}")) > sigma * F.col(f"_s_{c}"), F.lit(False)) for c in columns}
    return out.withColumns(masks).drop(*(f"_{x}_{c}" for c in columns for x in "ms"))


def drop_outliers(df: DataFrame) -> DataFrame:
    """Rows without any mask set; the masks go."""
    masks = [c for c in df.columns if c.endswith("_outlier")]
    for m in masks:
        df = df.filter(~F.col(m))
    return df.drop(*masks)


def winsorise(df: DataFrame, columns: Sequence[str], suffix: str = "_outliers_off", threshold: float = 0.99, keep: bool = True) -> DataFrame:
    """Absolute values, and a copy of each column cut at its quantile."""
    df = df.withColumns({c: F.abs(c) for c in columns})
    limits = quantile_limits(df, columns, threshold)
    cut = {c: F.least(F.col(c), F.lit(q)) if q is not None else F.col(c) for c, q in limits.items()}
    cut = {c: F.when(F.col(c).isNotNull(), x) for c, x in cut.items()}
    return df.withColumns({f"{c}{suffix}" if keep else c: x for c, x in cut.items()})


def winsorise_weights(df: DataFrame, columns: Sequence[str] = ("weight", "weight_kg"), suffix: str = "_outliers_off", threshold: float = 0.99, keep: bool = True) -> DataFrame:
    """As ``winsorise``, but outliers of every column are set to the least cutoff."""
    df = df.withColumns({c: F.abs(c) for c in columns})
    limits = quantile_limits(df, columns, threshold)
    least = min((q for q in limits.values() if q is not None), default=None)
    cut = {c: F.when(F.col(c) > q, F.lit(least)).otherwise(F.col(c)) if q is not None else F.col(c) for c, q in limits.items()}
    return df.withColumns({f"{c}{suffix}" if keep else c: x for c, x in cut.items()})


# -- duplicates, profiles, column utilities -----------------------------------


def drop_duplicated(df: DataFrame, subset: Sequence[str] | None = None, order: Sequence[str] | None = None) -> DataFrame:
    """One row for each key: any, or the first in ``order``."""
    if order is None:
        return df.dropDuplicates(list(subset) if subset else None)
    keys = list(subset or df.columns)
    rest = [c for c in df.columns if c not in keys]
    first = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return first.select(*(F.col(c) if c in keys else F.col(f"_r.{c}") for c in df.columns))


def drop_mismatches(df: DataFrame, key: str, name: str) -> DataFrame:
    """Of keys with several names (null counts as one), the row with the fewest
    nulls stays (ties: the least row); all other rows stay."""
    kinds = df.groupBy(key).agg((F.count_distinct(name) + F.max(F.col(name).isNull().cast("int"))).alias("_n"))
    bad = kinds.filter("_n > 1").select(F.col(key).alias("_k"))
    good = df.join(bad, F.col(key).eqNullSafe(F.col("_k")), "left_anti")
    nulls = sum((F.col(c).isNull().cast("int") for c in df.columns), F.lit(0))
    best = df.join(bad, F.col(key).eqNullSafe(F.col("_k")), "left_semi").groupBy(F.col(key).alias("_k")).agg(F.min(F.struct(nulls.alias("_nulls"), *(F.col(c) for c in df.columns))).alias("_r"))
    return good.unionByName(best.select("_r.*").drop("_nulls"))


def null_profile(df: DataFrame) -> DataFrame:
    """``(column, nulls, share)`` by share, from one pass."""
    n = len(df.columns)
    counts = df.agg(F.count("*").alias("_n"), *(F.count_if(F.col(c).isNull()).alias(f"_{i}") for i, c in enumerate(df.columns)))
    stacked = ", ".join(f"'{c}', _{i}" for i, c in enumerate(df.columns))
    out = counts.selectExpr("_n", f"stack({n}, {stacked}) as (column, nulls)")
    return out.select("column", "nulls", F.round(100 * F.col("nulls") / F.col("_n"), 4).alias("share")).orderBy(F.desc("share"), "column")


def report(df: DataFrame) -> DataFrame:
    """A row for each column of a table of numbers: count, nulls, distinct values,
    mean, deviation, ends, and its correlation with each column. One pass, and one
    that counts distinct values."""
    columns = df.columns
    stats = {"n": F.count, "nulls": lambda c: F.count_if(F.col(c).isNull()), "mean": lambda c: F.round(F.avg(c), 6), "deviation": lambda c: F.round(F.stddev_samp(c), 6), "least": F.min, "greatest": F.max}
    one = df.agg(*(F.struct(*(f(c).alias(k) for k, f in stats.items()), *(F.round(F.corr(c, d), 6).alias(d) for d in columns)).alias(c) for c in columns))
    values = df.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns))).alias("x")).select("x.*").filter("value is not null").distinct()
    kinds = values.groupBy("column").agg(F.count("*").alias("kinds"))
    rows = one.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).alias("s")) for c in columns))).alias("x")).select("x.column", "x.s.*")
    return rows.join(kinds, "column", "left").select("column", "n", "nulls", F.coalesce("kinds", F.lit(0)).alias("kinds"), "mean", "deviation", "least", "greatest", *columns)


def glimpse(df: DataFrame, rows: int = 5) -> dict:
    """Row counts, repeated rows, summary and a few rows."""
    total, kinds = df.count(), df.distinct().count()
    return {"rows": total, "repeated": total - kinds, "types": dict(df.dtypes), "summary": df.describe(), "sample": df.limit(rows)}


def detect_dates(df: DataFrame) -> DataFrame:
    """Text columns whose every value is a date become timestamps (one pass)."""
    texts = [c for c, t in df.dtypes if t == "string"]
    if not texts:
        return df
    row = df.agg(*(F.struct(F.count(c).alias("n"), F.count(F.try_to_timestamp(F.col(c))).alias("d")).alias(f"_{i}") for i, c in enumerate(texts))).first()
    return df.withColumns({c: F.try_to_timestamp(F.col(c)) for i, c in enumerate(texts) if row[f"_{i}"]["n"] and row[f"_{i}"]["n"] == row[f"_{i}"]["d"]})


def mixed_types(df: DataFrame) -> list[str]:
    """Text columns that hold numbers in some rows and other text in others."""
    texts = [c for c, t in df.dtypes if t == "string"]
    if not texts:
        return []
    row = df.agg(*(F.struct(F.count(c).alias("n"), F.count(F.col(c).try_cast("double")).alias("d")).alias(f"_{i}") for i, c in enumerate(texts))).first()
    return [c for i, c in enumerate(texts) if 0 < row[f"_{i}"]["d"] < row[f"_{i}"]["n"]]


def coerce(df: DataFrame, numbers: Sequence[str] = (), texts: Sequence[str] = (), times: Sequence[str] = (), days: Sequence[str] = (), as_int: bool = False) -> DataFrame:
    return df.withColumns({c: X.to_number(c) for c in numbers} | {c: X.to_text(c, as_int) for c in texts} | {c: F.try_to_timestamp(F.col(c).cast("string")) for c in times} | {c: X.to_day(F.col(c).cast("string")) for c in days})


def plain_types(df: DataFrame) -> DataFrame:
    """Narrow numbers widened: integers to bigint, or to double where they have nulls."""
    whole = [c for c, t in df.dtypes if t in ("tinyint", "smallint", "int")]
    row = df.agg(*(F.count_if(F.col(c).isNull()).alias(f"_{i}") for i, c in enumerate(whole))).first() if whole else ()
    new = {c: F.col(c).cast("double" if row[i] else "bigint") for i, c in enumerate(whole)}
    return df.withColumns(new | {c: F.col(c).cast("double") for c, t in df.dtypes if t == "float"})


def sorted_columns(df: DataFrame) -> DataFrame:
    return df.select(*sorted(df.columns))


def one_hot(df: DataFrame, columns: Sequence[str], most: int = 1000) -> DataFrame:
    """A 0/1 column for each value; a column of more than ``most`` values is an error."""
    for c in columns:
        values = [r[0] for r in df.select(c).filter(F.col(c).isNotNull()).distinct().limit(most + 1).collect()]
        if len(values) > most:
            raise ValueError(f"{c} has more than {most} values")
        df = df.withColumns({f"{c}_{v}": F.coalesce((F.col(c) == v).cast("int"), F.lit(0)) for v in sorted(values, key=str)}).drop(c)
    return df


def sample_rows(df: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows that a seeded hash picks (a sampling operator)."""
    return df.withColumn("_h", F.xxhash64(F.lit(seed), *df.columns)).orderBy("_h").limit(n).drop("_h")


def preclean(df: DataFrame, numbers: Sequence[str], days: Sequence[str] = (), since: str | None = None, threshold: float = 0.995) -> DataFrame:
    """For exploration: types, a lower date bound, rows without outliers and not all null."""
    df = coerce(df, numbers=numbers, days=days)
    if since:
        for d in days:
            df = df.filter(F.col(d) >= F.lit(since).cast("date"))
    masked, _ = quantile_mask(df, numbers, threshold)
    return drop_outliers(masked).na.drop("all")


def ranked_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")
