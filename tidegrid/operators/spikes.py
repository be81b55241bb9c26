"""Implausible readings (problem 1): physical limits, and an isolation forest per source.

1. Explicit rules: a reading that isn't finite, or isn't above zero, can't be true.
2. For all others features are computed against the source's own behaviour: level (how far a reading stands off the
   readings before and after it that agree with each other), difference (step from the reading before), season (the step
   against those usual at that hour of the day) and run length (how unlikely a run of equal readings is for the source).
   Readings are range-partitioned by (source, field, time, id) with sampled boundaries, so a chunk holds about
   ``rows_per_chunk`` rows whatever a source's share or its times; neighbouring rows and runs are carried across chunks
   over a table with one row a chunk.
3. A forest per source and field is grown on a bounded sample (``sample_rows``) with one reading of each of its runs, so that
   no stuck run fills the sample. Cuts are drawn over a box that reaches beyond the sample, so emptiness isolates as well.
4. The forest scores every reading. Its threshold is the least score this forest gives to its probes, readings
   that are the sample's median, or nothing, in all features but the level, or the run, and there right at the bound of
   what can be true. A reading whose score reaches the threshold is a candidate; an exact check of the same bounds follows (``spike_moves`` ordinary moves and
   ``spike_local`` local moves off on both sides, or a run less likely than ``run_chance``) and gives the reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.session import add_package, materialize

FEATURES = ("level", "step", "season", "run")
KEYS = ["source", "field_name"]
#: A spike lasts at most LONGEST readings; the local movement is the median over LOCAL readings to each side.
LONGEST, LOCAL = 5, 20
LENT = LOCAL + 1
#: A node is set apart once it holds at most one in FEW of a tree's rows, so that two like cases don't hide each other.
FEW = 40
#: Stands for a null id within the operator: it comes first.
NO_ID = -(2**63)


def long_readings(df: DataFrame, *, id_col: str, source: Column, time_ms: Column, fields: list[str]) -> DataFrame:
    """(id, source, at, field_name, value): one row for each non-null reading of a non-null source. Null times come first."""
    pairs = F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).cast("double").alias("v")) for f in fields])
    rows = df.select(F.col(id_col).alias("id"), source.alias("source"), F.coalesce(time_ms, F.lit(-1)).cast("long").alias("at"), F.explode(pairs).alias("p"))
    return rows.select("id", "source", "at", F.col("p.f").alias("field_name"), F.col("p.v").alias("value")).where("source is not null and value is not null")


def _placed(readings: DataFrame, rows_per_chunk: int) -> tuple[DataFrame, int]:
    """The readings in chunks that follow (source, field, time, id) and hold about rows_per_chunk rows each, and in how many
    partitions to work on them."""
    spark = readings.sparkSession
    total = readings.count()
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, min(usual, -(-total // 4_000)), -(-total // rows_per_chunk))
    order = [*KEYS, "at", "id"]
    out = readings.select(*KEYS, "at", F.coalesce("id", F.lit(NO_ID)).alias("id"), "value").repartitionByRange(parts, *order)
    return materialize(out.withColumn("chunk", F.spark_partition_id()), "readings"), max(usual, parts)


def _edge(pdf):
    """What a chunk shows its neighbours: rows, length of its first and last run of equal readings, first and last values."""
    import pandas as pd

    pdf = pdf.sort_values(["at", "id"], kind="stable")
    v = pdf.value.to_numpy()
    steps = (v[1:] != v[:-1]).nonzero()[0]
    lead, trail = (int(steps[0]) + 1, len(v) - 1 - int(steps[-1])) if len(steps) else (len(v), len(v))
    row = [pdf[k].iloc[0] for k in KEYS]
    return pd.DataFrame([(*row, int(pdf.chunk.iloc[0]), len(v), lead, trail, v[:LENT], v[-LENT:])], columns=[*KEYS, "chunk", "rows", "lead", "trail", "head", "tail"])


EDGE = "source string, field_name string, chunk int, rows long, lead long, trail long, head array<double>, tail array<double>"


def _context(edges: DataFrame) -> DataFrame:
    """Per chunk: the values before and after it, and the rows by which its first and last run go on in other chunks."""
    near = Window.partitionBy(*KEYS).orderBy("chunk")
    back = Window.partitionBy(*KEYS).orderBy(F.desc("chunk"))
    one = F.col("lead") == F.col("rows")
    rows = edges.select(
        *KEYS, "chunk", "lead", "trail", one.alias("one"),
        F.coalesce(F.element_at(F.lag("tail").over(near), -1) == F.col("head")[0], F.lit(False)).alias("goes_back"),
        F.coalesce(F.lead("head").over(near)[0] == F.element_at("tail", -1), F.lit(False)).alias("goes_on"),
        F.flatten(F.collect_list("tail").over(near.rowsBetween(-LENT, -1))).alias("before"),
        F.flatten(F.collect_list("head").over(near.rowsBetween(1, LENT))).alias("after"),
    )
    upto = lambda w: w.rowsBetween(Window.unboundedPreceding, 0)
    for side, length, w, stop in (("l", "trail", near, ~F.col("one") | ~F.col("goes_back")), ("r", "lead", back, ~F.col("one") | ~F.col("goes_on"))):
        total = F.sum(length).over(upto(w))
        rows = rows.withColumn(f"_{side}", total).withColumn(f"_{side}b", F.last(F.when(stop, F.col(f"_{side}") - F.col(length)), True).over(upto(w)))
    left = F.when(F.col("goes_back"), F.lag(F.col("_l") - F.col("_lb")).over(near)).otherwise(0)
    right = F.when(F.col("goes_on"), F.lag(F.col("_r") - F.col("_rb")).over(back)).otherwise(0)
    rows = rows.withColumn("left", left).withColumn("right", right)
    some = lambda c, low: F.when(F.size(c) > LENT, F.slice(c, low, LENT)).otherwise(F.col(c))
    return rows.select(*KEYS, "chunk", some("before", -LENT).alias("before"), some("after", 1).alias("after"), "left", "right")


def _features(pdf, context):
    """Rows of one chunk with diff (log step), run and nth (length of the run and place in it), off and local."""
    import numpy as np
    import pandas as pd

    columns = [*KEYS, "chunk", "at", "id", "diff", "run", "nth", "off", "local"]
    if not len(pdf):
        return pd.DataFrame(columns=columns)
    pdf = pdf.sort_values(["at", "id"], kind="stable")
    v, around = pdf.value.to_numpy(), context.iloc[0]
    before, after = (np.asarray(a, float) if a is not None else np.zeros(0) for a in (around.before, around.after))
    own = slice(len(before), len(before) + len(v))
    x = np.log(np.concatenate([before, v, after]))
    n = len(x)
    off = np.zeros(n)
    padded = np.concatenate([np.full(LONGEST, np.nan), x, np.full(LONGEST, np.nan)])
    with np.errstate(invalid="ignore"):
        for p in range(1, LONGEST + 1):
            a = padded[LONGEST - p : LONGEST - p + n]
            for q in range(1, LONGEST + 2 - p):
                b = padded[LONGEST + q : LONGEST + q + n]
                same = np.sign(x - a) == np.sign(x - b)
                off = np.fmax(off, np.where(same, np.minimum(np.abs(x - a), np.abs(x - b)) - np.abs(a - b), 0))
    diff = np.diff(x, prepend=np.nan)
    moves = pd.Series(np.abs(diff)).replace(0, np.nan)
    local = moves.rolling(2 * LOCAL + 1, center=True, min_periods=8).median().to_numpy()
    begins = np.concatenate([[0], np.flatnonzero(v[1:] != v[:-1]) + 1])
    sizes = np.diff(np.append(begins, len(v)))
    nth = np.arange(len(v)) - np.repeat(begins, sizes)
    nth[: sizes[0]] += int(around.left)
    sizes = sizes.copy()
    run = np.repeat(sizes, sizes)
    run[: sizes[0]] += int(around.left)
    run[len(v) - sizes[-1] :] += int(around.right)
    return pd.DataFrame({**{k: pdf[k] for k in [*KEYS, "chunk", "at", "id"]}, "diff": diff[own], "run": run, "nth": nth, "off": off[own], "local": local[own]})[columns]


FEATURED = "source string, field_name string, chunk int, at long, id long, diff double, run long, nth long, off double, local double"


def _movement(rows: DataFrame) -> DataFrame:
    """Per source and field: ordinary move (median of the steps that are none zero), share of repeats, and moves by hour.

    Steps are counted in bins of 1/256 octave, so the medians (within 0.14 %) don't depend on the order of the rows.
    """
    hour = F.pmod(F.floor(F.col("at") / 3_600_000), F.lit(24)).cast("int")
    size = F.floor(F.log2(F.when(F.abs("diff") > 0, F.abs("diff"))) * 256)
    counts = rows.groupBy(*KEYS, hour.alias("hour"), size.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("nth") > 0).alias("again"))
    moved = counts.where("bin is not null")
    middle = F.pow(F.lit(2.0), (F.col("bin") + 0.5) / 256)

    def median(by: list[str], name: str) -> DataFrame:
        bins = moved.groupBy(*by, "bin").agg(F.sum("n").alias("n"))
        upto = F.sum("n").over(Window.partitionBy(*by).orderBy("bin"))
        half = bins.withColumn("upto", upto).withColumn("total", F.sum("n").over(Window.partitionBy(*by))).where(F.col("upto") * 2 >= F.col("total"))
        return half.groupBy(*by).agg(F.min(middle).alias(name))

    hours = median([*KEYS, "hour"], "m").groupBy(*KEYS).agg(F.map_from_entries(F.collect_list(F.struct("hour", "m"))).alias("by_hour"))
    repeats = counts.groupBy(*KEYS).agg((F.sum("again") / F.sum("n")).alias("repeats"))
    return repeats.join(median(KEYS, "move"), KEYS, "left").join(hours, KEYS, "left")


def measures(pdf, move, repeats, by_hour, spike_moves: float, spike_local: float):
    """The forest's features of rows of one source as columns of an array (see FEATURES), the strength of the level (1: at
    the bound) and the log10 chance of the run. A source that never moves has no level, step or season."""
    import numpy as np

    still = not move or move != move
    unit = 1.0 if still else move
    usual = np.full(24, unit)
    for h, m in dict(by_hour or {}).items():
        usual[h] = m
    hour = (pdf["at"].to_numpy() // 3_600_000) % 24
    step = np.zeros(len(pdf)) if still else np.nan_to_num(np.abs(pdf["diff"].to_numpy(float)))
    off = np.zeros(len(pdf)) if still else pdf["off"].to_numpy(float)
    local = pdf["local"].to_numpy(float)
    local = np.maximum(np.where(np.isnan(local), unit, local), unit / 4)
    strength = np.minimum(off / (spike_moves * unit), off / (spike_local * local))
    chance = (pdf["run"].to_numpy(float) - 1) * np.log10(max(repeats, 1e-3))
    return np.stack([np.log1p(spike_moves * strength), np.log1p(step / unit), np.log1p(step / usual[hour]), np.log1p(-chance)], 1), strength, chance


class Forest:
    """An isolation forest in arrays: per node the feature (-1: a leaf), the cut, the left child, and for leaves the depth
    adjusted by the sample rows left there.

    Cuts are uniform over the node's box, which starts as the sample's extent widened to ``reach``; a side with hardly any
    sample rows (see FEW) is a leaf at once. So what lies beyond the sample is set apart early, and what lies among it late.
    """

    def __init__(self, sample, reach, trees: int, rows: int, seed: int):
        import numpy as np

        rng = np.random.default_rng(seed)
        sample = np.asarray(sample, np.float32)
        rows = min(rows, len(sample))
        self.depth = depth = max(1, int(np.ceil(np.log2(max(rows, 2)))) + 4)
        self.unit = max(self.average(rows), 1.0)
        low0, high0 = np.minimum(sample.min(0), 0.0).tolist(), np.maximum(sample.max(0), reach).tolist()
        few = max(1, rows // FEW)
        feature, cut, left, value, self.roots = [], [], [], [], []

        def leaf(level, n):
            feature.append(-1), cut.append(0.0), left.append(0), value.append(level + (self.average(n) if n > few else 0.0))

        for _ in range(trees):
            self.roots.append(len(feature))
            todo = [(len(feature), sample[rng.choice(len(sample), rows, replace=False)], low0, high0, 0)]
            leaf(0, rows)
            while todo:
                at, part, low, high, level = todo.pop()
                wide = [f for f in range(len(low)) if high[f] > low[f]]
                if level >= depth or len(part) <= few or not wide:
                    continue
                f = wide[int(rng.random() * len(wide))]
                c = float(np.float32(low[f] + rng.random() * (high[f] - low[f])))
                feature[at], cut[at], left[at] = f, c, len(feature)
                below = part[:, f] < c
                at_cut = min(max(c, low[f]), high[f])
                sides = (part[below], low, [*high[:f], at_cut, *high[f + 1 :]]), (part[~below], [*low[:f], at_cut, *low[f + 1 :]], high)
                for side in sides:
                    todo.append((len(feature), *side, level + 1))
                    leaf(level + 1, len(side[0]))
        self.arrays = [np.array(feature, np.int8), np.array(cut, np.float32), np.array(left, np.int32), np.array(value, np.float32)]

    @staticmethod
    def average(n: int) -> float:
        """Mean depth of an unsuccessful search among n rows."""
        import math

        return 0.0 if n < 2 else 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n if n > 2 else 1.0

    def score(self, data):
        """Between 0 and 1; the higher, the easier a row is set apart."""
        import numpy as np

        feature, cut, left, value = self.arrays
        n = len(data)
        flat = np.ascontiguousarray(np.asarray(data, np.float32).T).ravel()
        total, index = np.zeros(n), np.arange(n)
        column = feature.astype(np.int64) * n
        for root in self.roots:
            rows, node = index, np.full(n, root, np.int64)
            for _ in range(self.depth):
                node = left[node] + (flat[column[node] + rows] >= cut[node])
                done = feature[node] < 0
                if done.any():
                    total[rows[done]] += value[node[done]]
                    rows, node = rows[~done], node[~done]
                    if not len(rows):
                        break
        return 2.0 ** (-total / len(self.roots) / self.unit)


def score_readings(
    readings: DataFrame, *, rows_per_chunk: int = 50_000, trees: int = 50, tree_rows: int = 256, sample_rows: int = 2048, spike_moves: float = 12.0,
    spike_local: float = 9.5, run_chance: float = 1e-7, slack: float = 0.03, seed: int = 11,
) -> DataFrame:
    """(id, field_name, reason, score, threshold) of every reading: reason is null for plausible ones, else limit, spike or stuck.

    Order within a source: time, then id. Readings beyond the physical limits are left out of the neighbourhood of others.
    Of a stuck run all readings but the first are flagged. Doubled rows are readings like any other. A source whose
    readings never move has no spikes. score and threshold are null for readings beyond the limits. ``slack``: by how much the
    threshold lies under the lowest probe's score, for like cases that lie near each other beyond the bound. Scores depend on the
    readings alone, not on how they are partitioned. Empty input: no rows.
    """
    import math

    add_package(readings.sparkSession)
    possible = (F.col("value") > 0) & (F.col("value") < float("inf")) & ~F.isnan("value")
    none = F.lit(None).cast("double")
    limits = readings.where(~possible).select("id", "field_name", F.lit("limit").alias("reason"), none.alias("score"), none.alias("threshold"))
    by_chunk = [*KEYS, "chunk"]
    placed, parts = _placed(readings.where(possible), rows_per_chunk)
    placed = placed.repartition(parts, *by_chunk)  # a set number: small shuffles would be run together in one task
    context = _context(placed.groupBy(*by_chunk).applyInPandas(_edge, EDGE))
    featured = placed.groupBy(*by_chunk).cogroup(context.groupBy(*by_chunk)).applyInPandas(_features, FEATURED)
    featured = materialize(featured, "features")
    movement = _movement(featured)
    usual = int(readings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # one reading of each run: its first repeat, or the reading itself where nothing repeats
    begun = featured.where("nth = least(run - 1, 1)")
    chunks = featured.groupBy(*by_chunk).agg(F.count_if(F.expr("nth = least(run - 1, 1)")).alias("n"))
    rate = F.lit(float(sample_rows)) / F.sum("n").over(Window.partitionBy(*KEYS))
    drawn = F.pmod(F.xxhash64("id", "at", "diff", F.lit(seed)), F.lit(2**53)).cast("double") / F.lit(float(2**53)) < F.col("rate")
    sample = begun.join(chunks.withColumn("rate", rate).drop("n"), by_chunk).where(drawn).drop("rate", "chunk").join(movement, KEYS).repartition(usual, *KEYS)
    bounds, stuck_log = (spike_moves, spike_local), math.log10(run_chance)
    spike_level, stuck_level = math.log1p(spike_moves), math.log1p(-stuck_log)

    def grow(pdf):
        import pickle

        import numpy as np
        import pandas as pd

        pdf = pdf.sort_values(["id", "at", "diff", "run", "nth"], kind="stable")
        first = pdf.iloc[0]
        data, _, _ = measures(pdf, first.move, first.repeats, first.by_hour, *bounds)
        forest = Forest(data, np.array([2 * spike_level] * 3 + [2 * stuck_level]), trees, tree_rows, seed)
        probes = np.stack([np.median(data, 0), np.zeros(4)] * 2)
        probes[:2, 0], probes[2:, 3] = spike_level, stuck_level
        threshold = float(forest.score(probes).min()) - slack
        return pd.DataFrame([(first.source, first.field_name, pickle.dumps(forest), threshold)], columns=[*KEYS, "forest", "threshold"])

    forests = sample.groupBy(*KEYS).applyInPandas(grow, "source string, field_name string, forest binary, threshold double")

    def score(rows, model):
        import pickle

        import numpy as np
        import pandas as pd

        columns = ["id", "field_name", "reason", "score", "threshold"]
        if not len(rows):
            return pd.DataFrame(columns=columns)
        m = model.iloc[0]
        data, strength, chance = measures(rows, m.move, m.repeats, m.by_hour, *bounds)
        scores = pickle.loads(m.forest).score(data)
        candidate = scores >= m.threshold
        reason = np.full(len(rows), None, object)
        reason[candidate & (rows.nth.to_numpy() > 0) & (chance < stuck_log)] = "stuck"
        reason[candidate & (strength >= 1)] = "spike"
        return pd.DataFrame({"id": rows.id, "field_name": rows.field_name, "reason": reason, "score": scores, "threshold": m.threshold})[columns]

    models = chunks.select(*by_chunk).join(movement.join(forests, KEYS), KEYS)
    models = models.select(*[F.col(c).alias(c) for c in models.columns])  # columns of its own, as both sides come from one table
    scored = featured.repartition(parts, *by_chunk).groupBy(*by_chunk).cogroup(models.groupBy(*by_chunk)).applyInPandas(score, "id long, field_name string, reason string, score double, threshold double")
    scored = scored.withColumn("id", F.when(F.col("id") != NO_ID, F.col("id")))
    return scored.unionByName(limits)
