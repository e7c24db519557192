"""Work planning: areas, quotas, windows, batches, samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import js_round
from ..plans.tables import materialize

#: Area rules in order: (pattern on the path, area, weight). Fixed values.
AREA_RULES = [
    ("^reference/errors/", "errors", 5),
    ("^guides/cms/", "cms", 3),
    ("^guides/deploy/", "deploy", 6),
    ("^guides/integrations-guide/", "integrations", 16),
    ("^guides/migrate-to-", "migrate-from", 2),
    (r"^guides/upgrade-to/v[67]\z", "upgrade", 45),
    ("^guides/upgrade-to/", "upgrade-old", 4),
    ("^tutorial/", "tutorial", 2),
    ("^reference/modules/", "api-modules", 28),
    ("^reference/experimental-flags/", "experimental", 5),
    ("^reference/legacy-flags", "legacy", 3),
    ("^guides/backend/", "backend", 5),
    ("^guides/media/", "media", 4),
    ("^recipes/", "recipes", 8),
    ("^reference/", "reference", 28),
    ("^guides/", "guides", 28),
]
DEFAULT_AREA = ("basics", 18)


def classify(path: Column, rules: list[tuple[str, str, int]] = AREA_RULES, default: tuple[str, int] = DEFAULT_AREA) -> Column:
    """(area, weight) of the first rule whose pattern the path has."""
    out = None
    for pattern, area, weight in rules:
        value = F.struct(F.lit(area).alias("area"), F.lit(weight).alias("weight"))
        hit = F.regexp_like(path, F.lit(pattern))
        out = F.when(hit, value) if out is None else out.when(hit, value)
    other = F.struct(F.lit(default[0]).alias("area"), F.lit(default[1]).alias("weight"))
    return other if out is None else out.otherwise(other)


def allocate(pages: DataFrame, total: int = 6200, share: float = 0.9, weight: str = "weight", chunks: str = "chunks") -> DataFrame:
    """Adds quota: max(1, round(weight over the sum of weights times share of the total)) for pages with chunks, 0 for others.

    The sum is one number, so it is joined as one row instead of a window over everything.
    """
    whole = pages.where(F.col(chunks) > 0).agg(F.sum(weight).cast("double").alias("_w"))
    share_of = js_round(F.col(weight) / F.col("_w") * F.lit(float(total)) * F.lit(share))
    return pages.join(F.broadcast(whole)).withColumn("quota", F.when(F.col(chunks) > 0, F.greatest(F.lit(1).cast("long"), share_of)).otherwise(F.lit(0).cast("long"))).drop("_w")


def topic_quota(total: Column, topics: Column, extra: float = 0) -> Column:
    """round(max(2, round(a tenth of the total over the topics)) times (1 + extra))."""
    return js_round(F.greatest(F.lit(2).cast("long"), js_round(js_round(total * F.lit(0.1)) / topics)) * F.lit(1.0 + extra))


def numbered(df: DataFrame, order: list, by: list[str] | None = None, name: str = "n") -> DataFrame:
    """Adds ``name``: numbers rows from 0 in order, within groups if ``by`` is given; a null is a group too. A column of that name is replaced.

    Each range-partitioned part counts its own rows and adds those of the parts before, so no single task sorts
    everything, nor a whole group, however large.
    """
    by = by or []
    ranged = df.repartitionByRange(*by, *order).sortWithinPartitions(*by, *order)
    at = ranged.select(F.struct(*[F.col(f"`{c}`") for c in df.columns if c != name or c in by]).alias("r"), F.monotonically_increasing_id().alias("m"))
    at = materialize(at.select("r", F.shiftright("m", 33).alias("p"), F.col("m").bitwiseAND((1 << 33) - 1).alias("i")), "numbered")
    groups = [F.col(f"r.`{c}`").alias(f"g{k}") for k, c in enumerate(by)]
    own = [f"g{k}" for k in range(len(by))]
    sizes = at.groupBy(F.col("p").alias("q"), *groups).agg(F.count(F.lit(1)).alias("c"), F.min("i").alias("f"))
    over = Window.partitionBy(*own).orderBy("q").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("q", *own, "f", F.coalesce(F.sum("c").over(over), F.lit(0)).alias("b"))
    same = F.col("p") == F.col("q")
    for k, c in enumerate(by):
        same &= F.col(f"r.`{c}`").eqNullSafe(F.col(f"g{k}"))
    # one row per part without groups; with them their number isn't bounded
    return at.join(before if by else F.broadcast(before), same).select("r.*", (F.col("b") + F.col("i") - F.col("f")).alias(name))


def batches(df: DataFrame, size: int, order: list, by: list[str] | None = None) -> DataFrame:
    """Adds n, batch and pos (from 1) for batches of ``size``, within groups if given."""
    return numbered(df, order, by).withColumn("batch", F.floor(F.col("n") / size)).withColumn("pos", F.col("n") % size + 1)


def round_robin(df: DataFrame, n: int, order: list) -> DataFrame:
    return numbered(df, order).withColumn("slot", F.pmod("n", F.lit(n)))


def systematic_sample(df: DataFrame, n: int, order: list) -> DataFrame:
    """Rows floor(i * rows / n) for i under n; with n above the rows, all rows."""
    rows = numbered(df, order)
    total = rows.agg(F.count(F.lit(1)).alias("_t"))
    # row r is taken if some i has floor(i t / n) = r: i = ceil(r n / t) does and is under n
    i = F.ceil(F.col("n") * F.lit(n) / F.col("_t"))
    return rows.join(F.broadcast(total)).where((F.col("_t") <= n) | ((i < n) & (F.floor(i * F.col("_t") / F.lit(n)) == F.col("n")))).drop("_t")


def text_windows(df: DataFrame, text: str, size: int = 9000) -> DataFrame:
    """Explodes a text to windows of ``size`` code points: window (from 0) and part."""
    count = F.greatest(F.lit(1), F.ceil(F.length(text) / size).cast("int"))
    return df.withColumn("window", F.explode(F.sequence(F.lit(0), count - 1))).withColumn("part", F.substring(F.col(text), F.col("window") * size + 1, F.lit(size)))


def in_areas(df: DataFrame, areas: list[str] | None = None, area: str = "area") -> DataFrame:
    """Rows of the areas asked for; all if none is."""
    return df if areas is None else df.where(F.col(area).isin(areas))


def chunk_counts(pages: DataFrame, chunks: DataFrame, url: str = "url") -> DataFrame:
    """Pages with the number of their chunks, 0 without any."""
    return pages.join(chunks.groupBy(url).agg(F.count(F.lit(1)).alias("chunks")), url, "left").withColumn("chunks", F.coalesce("chunks", F.lit(0).cast("long")))


def jobs(df: DataFrame, quota: str = "quota", done: str = "done", per_call: int = 6, areas: list[str] | None = None) -> DataFrame:
    """A row per call still to make: batch from ceil(done / per_call) on, n = min(per_call, what is left); of some areas only if asked for."""
    df = in_areas(df, areas)
    left = F.col(quota) - F.col(done)
    first = F.ceil(F.col(done) / per_call)
    calls = F.ceil(left / per_call)
    out = df.where(left > 0).withColumn("_k", F.explode(F.sequence(F.lit(0).cast("long"), calls - 1)))
    return out.withColumn("batch", first + F.col("_k")).withColumn("n", F.least(F.lit(per_call).cast("long"), left - F.col("_k") * per_call).cast("int")).drop("_k")


def last_k(items: Column, k: int) -> Column:
    """The last k entries of an array."""
    return F.slice(items, F.greatest(F.size(items) - k + 1, F.lit(1)), F.lit(k))
