"""Quantiles that are elements of the data: approximate in one pass, exact in two or three.

The approximate form is one mergeable sketch per group.  The exact form uses such a sketch only
to bracket each answer.  Values inside a bracket are then counted one by one, all others only
per gap between brackets, which map-side combining reduces before the shuffle.  Brackets are cut
into slices; counts per slice place each rank in one of them, so that only a slice is ever sorted.

Whole columns need no group key.  Their brackets become constants of the plan: one aggregate counts
what lies below each bracket of every column, and only rows with a value inside some bracket are
unfolded.  A bracket whose ends are equal is its own answer.
"""

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.text import literal, quoted

# Expressions over every column of a table are SQL text: one call to the JVM per expression
# instead of one per node.

ACCURACY = 10000
SALTS = 16
SLICES = 1024  # of a bracket


def clean_double(name):
    """SQL for the column as a double, NaN as NULL."""
    return f"nanvl(cast({quoted(name)} as double), cast(null as double))"


def _sketch(x, probabilities, accuracy):
    wanted = ", ".join(f"{float(p)!r}D" for p in probabilities)
    return f"percentile_approx({x}, array({wanted}), {accuracy})"


def _ends(probabilities, accuracy):
    """Probabilities whose sketched values are certain to enclose each exact quantile."""
    margin = 4.0 / accuracy
    return [end for p in probabilities for end in (max(0.0, p - margin), min(1.0, p + margin))]


def _collapse(x, ends, how_many):
    """SQL for (value, bracket, slice of the bracket), with one stand-in for each gap between
    brackets, whose bracket is -1 and whose slice is the number of the gap.

    The stand-in is the lower end of the next bracket and sorts just before its values; behind
    the last bracket the value no longer matters.
    """
    spans = [(f"{ends}[{2 * i}]", f"{ends}[{2 * i + 1}]") for i in range(how_many)]
    inside = [f"when {x} between {lo} and {hi} then " for lo, hi in spans]
    bracket = "case " + " ".join(f"{w}{i}" for i, w in enumerate(inside)) + " else -1 end"
    gap = " + ".join(f"if({lo} <= {x}, 1, 0)" for lo, _ in spans)
    part = "case " + " ".join(
        f"{w}if({hi} > {lo}, least(floor(({x} - {lo}) / ({hi} - {lo}) * {SLICES}), "
        f"{SLICES - 1}), 0)" for w, (lo, hi) in zip(inside, spans)) + f" else {gap} end"
    following = "least(" + ", ".join(f"if({lo} > {x}, {lo}, null)" for lo, _ in spans) \
        + ", double('inf'))"
    value = f"if({bracket} >= 0, {x}, {following})"
    return f"{value} as _x", f"{bracket} as _b", f"cast({part} as int) as _f"


def read_off(residue, keys, probabilities, outputs):
    """Quantiles per key from rows (_n, _x, _b, _f, _c): total, value, bracket, slice, count.

    Counts per slice tell which slice holds each rank; only the values of these slices are sorted.
    """
    counted = residue.groupBy(*keys, "_n", "_b", "_f", "_x").agg(F.sum("_c").alias("_c"))
    slices = counted.groupBy(*keys, "_n", "_b", "_f").agg(
        F.sum("_c").alias("_m"), F.min("_x").alias("_lo"))
    # A few thousand slices per key, however many values.
    order = Window.partitionBy(*keys).orderBy("_lo", F.col("_b") >= 0, "_b", "_f").rowsBetween(
        Window.unboundedPreceding, -1)
    ranks = F.array(*[F.struct(F.lit(i).alias("i"), F.greatest(
        F.lit(1), F.ceil(F.lit(float(p)) * F.col("_n"))).alias("rank"))
        for i, p in enumerate(probabilities)])
    wanted = slices.withColumn("_before", F.coalesce(F.sum("_m").over(order), F.lit(0))).where(
        "_b >= 0").withColumn("_r", F.explode(ranks)).where(
        "_r.rank > _before and _r.rank <= _before + _m")
    wanted = wanted.select(*[F.col(k).alias(f"_w{j}") for j, k in enumerate(keys)],
                           F.col("_b").alias("_wb"), F.col("_f").alias("_wf"), "_before", "_r")
    same = [F.col(k).eqNullSafe(F.col(f"_w{j}")) for j, k in enumerate(keys)]
    found = counted.join(wanted, [*same, F.col("_b") == F.col("_wb"), F.col("_f") == F.col("_wf")])
    upto = Window.partitionBy(*keys, "_r").orderBy("_x").rowsBetween(Window.unboundedPreceding, 0)
    found = found.withColumn("_rank", F.col("_before") + F.sum("_c").over(upto)).where(
        F.col("_rank") >= F.col("_r.rank"))
    return found.groupBy(*keys).agg(*[
        F.min(F.when(F.col("_r.i") == i, F.col("_x"))).alias(o) for i, o in enumerate(outputs)])


def column_quantiles(df: DataFrame, columns, probabilities, outputs, exact=False,
                     accuracy=ACCURACY) -> DataFrame:
    """Per named numeric column, the smallest value whose cumulative share reaches each
    probability.  NULL and NaN are left out; a column without values gives no row.
    """
    if exact:
        return exact_quantiles({"": (df, columns)}, probabilities, outputs, accuracy).drop(
            "table_name")
    return _sketched(df, columns, probabilities, accuracy).select(
        "column_name", *[F.col("q")[i].alias(o) for i, o in enumerate(outputs)])


def _sketched(df, columns, probabilities, accuracy):
    """(column_name, n, q) of the columns that have values."""
    data, names = _aliased(df, columns)
    long = _column_sketches(data, names, probabilities, accuracy).unpivot([], names, "a", "e")
    return long.where("e.n > 0").select(_title(names, columns), "e.n", "e.q")


def exact_quantiles(tables: dict, probabilities, outputs, accuracy=ACCURACY) -> DataFrame:
    """Exact quantiles of the columns of several tables, ``{name: (table, columns)}``.

    Returns table_name, column_name and the outputs.  The brackets pass through the driver: two
    numbers per column and probability, whatever the number of rows.
    """
    spark = next(iter(tables.values()))[0].sparkSession
    brackets = reduce(DataFrame.unionByName, [
        _sketched(df, columns, _ends(probabilities, accuracy), accuracy).select(
            F.lit(table).alias("table_name"), "*")
        for table, (df, columns) in tables.items()]).collect()
    settled, cells = [], []
    for row in brackets:
        for i, p in enumerate(probabilities):
            low, high = row["q"][2 * i], row["q"][2 * i + 1]
            if low == high:
                settled.append((row["table_name"], row["column_name"], i, low))
            else:
                rank = F.greatest(F.lit(1), F.ceil(F.lit(float(p)) * F.lit(row["n"])))
                cells.append((row["table_name"], row["column_name"], i, low, high, rank))
    found = spark.createDataFrame(
        settled, "table_name string, column_name string, i int, x double")
    if cells:
        below, inside = [], []
        for table, (df, columns) in tables.items():
            own = [(k, *cell[1:]) for k, cell in enumerate(cells) if cell[0] == table]
            if own:
                data, names = _aliased(df, columns)
                alias = dict(zip(columns, map(F.col, names)))
                below.append(_below(data, table, alias, own))
                inside.append(_inside(data, alias, own))
        found = found.unionByName(_ranked(reduce(DataFrame.unionByName, inside),
                                          reduce(DataFrame.unionByName, below)))
    return found.groupBy("table_name", "column_name").agg(*[
        F.min(F.when(F.col("i") == i, F.col("x"))).alias(o) for i, o in enumerate(outputs)])


def _below(data, table, alias, cells):
    """(k, table_name, column_name, i, rank, before): how many values lie below each bracket."""
    counts = data.agg(*[F.count_if(alias[c] < F.lit(low)).alias(f"b{k}")
                        for k, c, _, low, _, _ in cells])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(k).alias("k"), F.lit(table).alias("table_name"),
                 F.lit(c).alias("column_name"), F.lit(i).alias("i"),
                 rank.cast("long").alias("rank"), F.col(f"b{k}").alias("before"))
        for k, c, i, _, _, rank in cells])))


def _inside(data, alias, cells):
    """(k, f, x): bracket, slice of the bracket, and value, of the values inside a bracket."""
    within, entries = [], []
    for k, c, _, low, high, _ in cells:
        x, low, high = alias[c], F.lit(low), F.lit(high)
        within.append((x >= low) & (x <= high))
        part = F.floor((x - low) / (high - low) * F.lit(SLICES))
        entries.append(F.when(within[-1], F.struct(
            F.lit(k).alias("k"), F.least(part, F.lit(SLICES - 1)).cast("int").alias("f"),
            x.alias("x"))))
    held = data.where(reduce(lambda a, b: a | b, within))
    return held.select(F.inline(F.filter(F.array(*entries), F.isnotnull)))


def _ranked(values, below):
    """(table_name, column_name, i, x): per bracket the value of the wanted rank."""
    counted = values.groupBy("k", "f", "x").agg(F.count("*").alias("c"))
    earlier = Window.partitionBy("k").orderBy("f").rowsBetween(Window.unboundedPreceding, -1)
    # At most SLICES rows per bracket.
    slices = counted.groupBy("k", "f").agg(F.sum("c").alias("m")).withColumn(
        "ahead", F.coalesce(F.sum("m").over(earlier), F.lit(0))).join(F.broadcast(below), "k")
    wanted = slices.withColumn("ahead", F.col("ahead") + F.col("before")).where(
        "rank > ahead and rank <= ahead + m").drop("m", "before")
    upto = Window.partitionBy("k").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    found = counted.join(F.broadcast(wanted), ["k", "f"]).withColumn(
        "place", F.col("ahead") + F.sum("c").over(upto)).where("place >= rank")
    return found.groupBy("table_name", "column_name", "i").agg(F.min("x").alias("x"))


def _aliased(df, columns):
    """The columns as clean doubles under names that need no quoting."""
    names = [f"c{i}" for i in range(len(columns))]
    return df.selectExpr(*[f"{clean_double(c)} as {a}" for c, a in zip(columns, names)]), names


def _column_sketches(data, names, probabilities, accuracy):
    """One row with a struct (n, q) per column."""
    return data.selectExpr(*[f"struct(count({a}) as n, {_sketch(a, probabilities, accuracy)} as q)"
                             f" as {a}" for a in names])


def _title(names, columns):
    pairs = ", ".join(f"'{a}', {literal(c)}" for a, c in zip(names, columns))
    return F.expr(f"element_at(map({pairs}), a) as column_name")


def grouped_quantiles(df: DataFrame, keys, value, probabilities, outputs, exact=False,
                      accuracy=ACCURACY) -> DataFrame:
    """Per key, the smallest value whose cumulative share reaches each probability.

    NULL and NaN are left out; a key without values gives no row.
    """
    data = df.select(*keys, F.expr(f"{clean_double(value)} as _x")).where(
        F.col("_x").isNotNull())
    if not exact:
        sketch = data.groupBy(*keys).agg(
            F.expr(_sketch("_x", probabilities, accuracy)).alias("_q"))
        return sketch.select(*keys, *[F.col("_q")[i].alias(o) for i, o in enumerate(outputs)])

    # One row per (key, value), spread over salted copies of the one bracket row per key, so
    # neither many copies of a value nor a hot key meets in one task.
    counted = (data.groupBy(*keys, "_x").agg(F.count("*").alias("_c"))
               .withColumn("_s", F.pmod(F.xxhash64("_x"), F.lit(SALTS)).cast("int")))
    titles = [f"_k{i}" for i in range(len(keys))]
    brackets = data.groupBy(*[F.col(k).alias(t) for k, t in zip(keys, titles)]).agg(
        F.count("_x").alias("_n"),
        F.expr(_sketch("_x", _ends(probabilities, accuracy), accuracy)).alias("_ends"))
    copies = brackets.withColumn("_t", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    same = [F.col(k).eqNullSafe(F.col(t)) for k, t in zip(keys, titles)]
    placed = counted.join(copies, [*same, F.col("_s") == F.col("_t")])
    residue = placed.withColumnRenamed("_x", "_v").select(
        *keys, "_n", "_c", *map(F.expr, _collapse("_v", "_ends", len(outputs))))
    return read_off(residue, keys, probabilities, outputs)


def quantile_trim(df: DataFrame, column, low=0.01, high=0.99, exact=True,
                  accuracy=ACCURACY) -> DataFrame:
    """Rows whose value lies between two quantiles of the column, both ends included.

    The bounds reach the filter as scalar subqueries, so nothing runs on the driver.
    """
    bounds = column_quantiles(df, [column], [low, high], ["lo", "hi"], exact, accuracy).select(
        F.struct("lo", "hi")).scalar()
    return df.where((F.col(column) >= bounds["lo"]) & (F.col(column) <= bounds["hi"]))
