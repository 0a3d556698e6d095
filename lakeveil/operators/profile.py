"""Column samples: the k smallest distinct values of a column by (md5, value).

The order makes a sample reproducible and any engine can recompute it. A plain
``distinct`` over the unpivoted table would shuffle every value of every
column. Instead:

1. one map-side pass estimates the distinct count of every column (a sketch of
   a few KB per column and task), in all and within each task;
2. each column gets a digest bound that about ``_HEADROOM * k`` of its distinct
   values fall under, so the second pass shuffles only those. Columns with few
   distinct values are reduced to their sets first, and only these get a text
   and a digest; of the others each has a scan of its own, which reads no more
   of a columnar file and keeps the generated code short. Numbers and times that
   come back often within a task are made distinct as they are, before any text
   or digest: a task's repeats never leave it, and a digest costs several times as much;
3. should fewer than k fall under a bound, that column is read again with
   no bound. The result is exact either way.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeveil.functions.sqltext import identifier, string
from lakeveil.functions.text import raw_text_sql, repair_text_sql
from lakeveil.sources.workspace import stored

DEFAULT_SAMPLE_SIZE = 50
STORED_SAMPLE_SIZE = 10

# With 4 * k values expected under a bound, and the distinct count known to about
# 20 % where it is 200, 3 % where it is great, a shortfall is rare; step 3 covers it all the same.
_HEADROOM = 4
_BOUND_DIGITS = 12
_SKETCH_SIZE = 10  # log2 of the sketch's buckets
_THINNING = 32  # one hash in so many is sketched, as updating a sketch costs more than hashing
# Up to so many distinct values of fixed width are gathered as a set in each task.
_FEW = 10_000
_FIXED_WIDTH = (T.IntegralType, T.FloatType, T.DoubleType, T.DateType, T.TimestampType, T.TimestampNTZType)
# Columns are made distinct before their digests if that leaves one row in so many: the shuffle stays below that share.
_REPEATS = 6
# Branches with digests per table: wider tables have several columns in each.
_BRANCHES = 24
# Scans per table for the sketches. A file that can't be split is one task per scan, so columns are spread over several,
# with so many columns each at least: every scan costs code to compile and tasks to start.
_SKETCH_SCANS = 4
_SKETCH_COLUMNS = 4
# Tables of so many rows a task in fewer tasks than the session has cores (files that can't be split) have a branch for
# each column with few values and a stage for each branch, all side by side.
_MANY_ROWS = 1_000_000
# Tables per Spark job: keeps a plan over a wide catalogue small enough to compile.
_TABLES_PER_JOB = 32

Columns = dict[str, list[str]]


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, frames)


def _batches(names: list[str]) -> list[list[str]]:
    return [names[i : i + _TABLES_PER_JOB] for i in range(0, len(names), _TABLES_PER_JOB)]


def _parts(names: list[str], most: int, least_size: int = 1) -> list[list[str]]:
    """``names`` in at most so many parts of one size."""
    size = max(-(-len(names) // most), least_size)
    return [names[i : i + size] for i in range(0, len(names), size)]


def _chosen(tables: dict[str, DataFrame], columns: Columns | None) -> Columns:
    for table, names in (columns or {}).items():
        missing = sorted(set(names) - set(tables[table].columns))
        if missing:
            raise ValueError(f"table {table} has no column {', '.join(missing)}")
    chosen = columns if columns is not None else {t: df.columns for t, df in tables.items()}
    return {t: list(cols) for t, cols in chosen.items() if cols}


def _hashable(df: DataFrame, name: str) -> str:
    data_type = df.schema[name].dataType
    if isinstance(data_type, (T.MapType, T.VariantType)):
        return f"cast({identifier(name)} as string)"
    return identifier(name)


def distinct_estimates(tables: dict[str, DataFrame], columns: Columns | None = None) -> DataFrame:
    """(table_name, column_name, approx_distinct, within_tasks, n_rows, n_tasks); only sketches leave the map side.

    ``within_tasks`` is the sum of the tasks' own distinct counts, ``n_rows`` the table's rows, ``n_tasks`` the tasks of a
    scan that had any. Counts are 0 where
    no hash is sketched, as a column has few values or none; tables without rows are left out. Hashes are unpivoted
    and thinned in generated code.
    """
    thin = f"& {_THINNING - 1} = 0"
    frames = []
    names_of = _chosen(tables, columns)
    for t, (table, names) in enumerate(names_of.items()):
        df = tables[table]
        hashes = {f"c{i}": f"xxhash64({_hashable(df, n)})" for i, n in enumerate(names)}
        # One row in so many, in a column of its own: it counts the rows.
        hashes["n"] = f"if(monotonically_increasing_id() {thin}, 0L, 1L)"
        for some in _parts(list(hashes), _SKETCH_SCANS, _SKETCH_COLUMNS):
            wide = df.selectExpr("spark_partition_id() as task", *[f"{hashes[c]} as {c}" for c in some])
            values = wide.unpivot(["task"], some, "c", "h").where(f"h {thin}")
            frames.append(values.selectExpr(f"{t} as t", "c", "task", "h"))
    sketches = union_all(frames).groupBy("t", "c", "task").agg(
        F.expr(f"hll_sketch_agg(h, {_SKETCH_SIZE}) as s"), F.count(F.lit(1)).alias("n")
    )
    merged = sketches.groupBy("t", "c").agg(
        F.expr(f"{_THINNING} * hll_sketch_estimate(hll_union_agg(s)) as approx_distinct"),
        F.expr(f"{_THINNING} * sum(hll_sketch_estimate(s)) as within_tasks"),
        F.expr(f"{_THINNING} * sum(n) as n"),
        F.count(F.lit(1)).alias("tasks"),
    )
    # One row per table, with an entry per column.
    found = merged.groupBy("t").agg(F.expr("map_from_entries(collect_list((c, (approx_distinct, within_tasks, n, tasks)))) as found"))
    tables_sql = f"array({', '.join(map(string, names_of))})"
    lists = [f"array({', '.join(map(string, names))})" for names in names_of.values()]
    named = found.selectExpr("t", "found", f"posexplode(element_at(array({', '.join(lists)}), t + 1)) as (i, column_name)")
    return named.withColumn("own", F.expr("try_element_at(found, concat('c', i))")).selectExpr(
        f"element_at({tables_sql}, t + 1) as table_name",
        "column_name",
        "coalesce(own.approx_distinct, 0L) as approx_distinct",
        "coalesce(own.within_tasks, 0L) as within_tasks",
        "found['n'].n as n_rows",
        "found['n'].tasks as n_tasks",
    )


class _Bounds(dict):
    """Digest bounds by (table, column); ``repeated`` are the columns whose tasks hold few distinct values for their rows,
    ``narrow`` the tables read in few tasks of ``_MANY_ROWS`` rows."""

    def __init__(
        self, bounds: dict | None = None, repeated: set[tuple[str, str]] = frozenset(), narrow: set[str] = frozenset()
    ) -> None:
        super().__init__(bounds or {})
        self.repeated, self.narrow = set(repeated), set(narrow)


def _repeated(bounds: dict) -> set[tuple[str, str]]:
    return getattr(bounds, "repeated", set())


def _narrow(bounds: dict) -> set[str]:
    return getattr(bounds, "narrow", set())


def _digest_bounds(tables: dict[str, DataFrame], columns: Columns, k: int) -> dict[tuple[str, str], str]:
    """Digest bounds for columns with many distinct values; the others need none."""
    bounds = _Bounds()
    for batch in _batches(list(columns)):
        for row in distinct_estimates(tables, {t: columns[t] for t in batch}).collect():
            cores = tables[row.table_name].sparkSession.sparkContext.defaultParallelism
            if row.n_tasks < cores and row.n_rows >= _MANY_ROWS * row.n_tasks:
                bounds.narrow.add(row.table_name)
            if row.approx_distinct > _HEADROOM * k:
                fraction = _HEADROOM * k / row.approx_distinct
                bounds[row.table_name, row.column_name] = f"{int(fraction * 16**_BOUND_DIGITS):0{_BOUND_DIGITS}x}"
                # Columns with up to _FEW values are gathered as sets.
                fixed = isinstance(tables[row.table_name].schema[row.column_name].dataType, _FIXED_WIDTH)
                if fixed and row.approx_distinct > _FEW and row.within_tasks * _REPEATS <= row.n_rows:
                    bounds.repeated.add((row.table_name, row.column_name))
    return bounds


def _few(tables: dict[str, DataFrame], columns: Columns, bounds: dict, k: int) -> set[tuple[str, str]]:
    """The columns with few enough distinct values to be gathered as sets, by the ``_digest_bounds`` of ``columns``."""
    few = set()
    for table, names in columns.items():
        for name in names:
            data_type, bound = tables[table].schema[name].dataType, bounds.get((table, name))
            if bound is None:
                fits = isinstance(data_type, (*_FIXED_WIDTH, T.StringType, T.BooleanType))
            else:
                # The bound tells the estimate.
                fits = isinstance(data_type, _FIXED_WIDTH) and int(bound, 16) * _FEW >= _HEADROOM * k * 16**_BOUND_DIGITS
            if fits:
                few.add((table, name))
    return few


def _few_values(df: DataFrame, names: list[str]) -> DataFrame:
    """(column_name, sample_value) of columns with few distinct values, each value about once."""
    sets = df.selectExpr(*[f"collect_set({identifier(n)}) as s{i}" for i, n in enumerate(names)])
    pairs = []
    for i, n in enumerate(names):
        data_type = df.schema[n].dataType
        raw = f"transform(s{i}, v -> {raw_text_sql('v', data_type)})"
        pairs.append(f"struct({string(n)} as column_name, transform({raw}, t -> {repair_text_sql('t', data_type)}) as s)")
    return sets.selectExpr(f"inline(array({', '.join(pairs)}))").selectExpr("column_name", "explode(s) as sample_value")


def _values(df: DataFrame, names: list[str]) -> DataFrame:
    """(column_name, sample_value) of all values, with repeats.

    Text repair comes after the unpivot, as the digest does, so their code exists once
    and not once per column: methods over 8000 bytes of bytecode are interpreted.
    """
    types = {n: df.schema[n].dataType for n in names}
    texts = df.selectExpr(*[f"{raw_text_sql(identifier(n), types[n])} as {identifier(n)}" for n in names])
    values = texts.unpivot([], [quoted(n) for n in names], "column_name", "sample_value").where(
        "sample_value is not null"
    )
    repairs: dict[str, list[str]] = {}
    for name, data_type in types.items():
        repairs.setdefault(repair_text_sql("sample_value", data_type), []).append(string(name))
    if len(repairs) == 1:
        return values.selectExpr("column_name", f"{next(iter(repairs))} as sample_value")
    cases = " ".join(f"when column_name in ({', '.join(n)}) then {r}" for r, n in repairs.items())
    return values.selectExpr("column_name", f"case {cases} end as sample_value")


def _under_bounds(values: DataFrame, names: list[str], bounds: dict[str, str]) -> DataFrame:
    """``values`` of the columns ``names`` whose digests are below the bound of their column, if it has one."""
    own = {n: bounds[n] for n in names if n in bounds}
    if not own:
        return values
    cases = " ".join(f"when {string(n)} then '{bound}'" for n, bound in own.items())
    condition = f"md5(sample_value) < case column_name {cases} end"
    free = [string(n) for n in names if n not in own]
    return values.where(f"column_name in ({', '.join(free)}) or {condition}" if free else condition)


def _candidates(df: DataFrame, table: str, names: list[str], bounds: dict, few: set = frozenset()) -> DataFrame:
    """(table_name, column_name, sample_value): the values under their bounds; some repeats are left."""
    own = {n: bounds[table, n] for n in names if (table, n) in bounds}
    repeated = [n for n in names if (table, n) in _repeated(bounds)][:_BRANCHES]
    sets = [n for n in names if (table, n) in few and n not in repeated]
    open_ones = [n for n in names if n not in sets and n not in own]
    bounded = [n for n in names if n not in sets and n not in repeated and n in own]
    narrow = table in _narrow(bounds)
    parts = [_under_bounds(_few_values(df, some), some, own) for some in _parts(sets, _BRANCHES if narrow else 1)]
    if open_ones:
        parts.append(_values(df, open_ones))
    parts += [_under_bounds(_values(df.select(quoted(n)).distinct(), [n]), [n], own) for n in repeated]
    for some in _parts(bounded, _BRANCHES):
        under = _under_bounds(_values(df, some), some, own)
        # With a shuffle of its own, of few values, it doesn't wait for the stages of the others.
        parts.append(under.distinct() if narrow else under)
    return union_all(parts).selectExpr(f"{string(table)} as table_name", "column_name", "sample_value")


def _smallest(candidates: DataFrame, k: int) -> DataFrame:
    keyed = candidates.distinct().withColumn("digest", F.md5("sample_value"))
    rank = "row_number() over (partition by table_name, column_name order by digest, sample_value)"
    return (
        keyed.withColumn("sample_rank", F.expr(rank))
        .where(F.col("sample_rank") <= k)
        .select("table_name", "column_name", "sample_rank", "sample_value")
    )


def sample_tables(
    tables: dict[str, DataFrame],
    columns: Columns | None = None,
    sample_size: int = DEFAULT_SAMPLE_SIZE,
) -> DataFrame:
    """Samples of many tables: (table_name, column_name, sample_rank, sample_value).

    The result holds at most ``sample_size`` values per column and is a stored table,
    because checking it and using it would otherwise scan the tables twice. Nothing is cached.
    """
    chosen = _chosen(tables, columns)
    if not chosen:
        raise ValueError("no columns to sample")
    bounds = _digest_bounds(tables, chosen, sample_size)
    few = _few(tables, chosen, bounds, sample_size)
    parts = []
    for batch in _batches(list(chosen)):
        candidates = union_all([_candidates(tables[t], t, chosen[t], bounds, few) for t in batch])
        part = stored(_smallest(candidates, sample_size), "samples")
        bounded = {key for key in bounds if key[0] in batch}
        if bounded:
            found = {
                (r.table_name, r.column_name): r.n
                for r in part.groupBy("table_name", "column_name").agg(F.count(F.lit(1)).alias("n")).collect()
            }
            short = [key for key in bounded if found.get(key, 0) < sample_size]
            if short:
                part = _with_unbounded(part, tables, short, sample_size)
        parts.append(part)
    return union_all(parts)


def _with_unbounded(
    part: DataFrame, tables: dict, short: list[tuple[str, str]], k: int, known: DataFrame | None = None
) -> DataFrame:
    """Replace the samples of the columns in ``short`` by unbounded ones, of ``known`` values too."""
    again: Columns = {}
    for table, name in short:
        again.setdefault(table, []).append(name)
    keep = [
        ~((F.col("table_name") == t) & F.col("column_name").isin(*names)) for t, names in again.items()
    ]
    others = reduce(lambda a, b: a & b, keep)
    values = [_candidates(tables[t], t, names, {}) for t, names in again.items()]
    if known is not None:
        values.append(known.where(~others))
    return part.where(others).unionAll(_smallest(union_all(values), k))


def merge_samples(
    state: DataFrame, tables: dict[str, DataFrame], columns: Columns, sample_size: int = DEFAULT_SAMPLE_SIZE
) -> DataFrame:
    """The samples of rows seen before and of new ones, from the earlier samples and the new rows alone.

    ``state`` has samples as ``sample_tables`` gives them, ``tables`` the new rows. The k smallest of all are among
    the k smallest of both parts, so the result is that of reading everything. Where the state holds k values, its
    greatest digest bounds what is taken from the new rows: one pass, without a sketch.
    """
    chosen = _chosen(tables, columns)
    if not chosen:
        return state
    held = state.groupBy("table_name", "column_name").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.md5("sample_value")).alias("last")
    )
    # One row per column.
    bounds = {(r.table_name, r.column_name): r.last for r in held.collect() if r.n >= sample_size}
    open_columns = {t: [n for n in names if (t, n) not in bounds] for t, names in chosen.items()}
    open_columns = {t: names for t, names in open_columns.items() if names}
    estimated = _digest_bounds(tables, open_columns, sample_size) if open_columns else {}
    few = _few(tables, open_columns, estimated, sample_size)
    all_bounds = _Bounds(bounds | estimated, _repeated(estimated), _narrow(estimated))
    known = state.select("table_name", "column_name", "sample_value")
    candidates = [
        union_all([_candidates(tables[t], t, chosen[t], all_bounds, few) for t in batch])
        for batch in _batches(list(chosen))
    ]
    part = stored(_smallest(union_all([known, *candidates]), sample_size), "samples")
    if not estimated:
        return part
    counts = part.groupBy("table_name", "column_name").agg(F.count(F.lit(1)).alias("n")).collect()
    found = {(r.table_name, r.column_name): r.n for r in counts}
    short = [key for key in estimated if found.get(key, 0) < sample_size]
    return _with_unbounded(part, tables, short, sample_size, known) if short else part


def sample_column(df: DataFrame, column: str, sample_size: int = DEFAULT_SAMPLE_SIZE) -> DataFrame:
    """(sample_rank, sample_value) of one column."""
    return sample_tables({"": df}, {"": [column]}, sample_size).select("sample_rank", "sample_value")


def samples_as_arrays(samples: DataFrame) -> DataFrame:
    """One row per column with ``sample_values`` in sample order."""
    pairs = F.array_sort(F.collect_list(F.struct("sample_rank", "sample_value")))
    return samples.groupBy("table_name", "column_name").agg(
        F.transform(pairs, lambda p: p["sample_value"]).alias("sample_values")
    )


def stored_samples(sample_values: Column, keep: int = STORED_SAMPLE_SIZE) -> Column:
    """The first ``keep`` samples, as kept in the catalogue after a scan."""
    return F.slice(sample_values, 1, keep)


def schema_frame(tables: dict[str, DataFrame], namespace: str) -> DataFrame:
    """(namespace, table_name, ordinal, column_name, data_type, data_type_repr) of many tables."""
    import pyarrow as pa

    spark = next(iter(tables.values())).sparkSession
    rows = [
        (namespace, table, i, f.name, f.dataType.simpleString(), str(f.dataType))
        for table, df in tables.items()
        for i, f in enumerate(df.schema.fields)
    ]
    names = ["namespace", "table_name", "ordinal", "column_name", "data_type", "data_type_repr"]
    schema = pa.schema([(n, pa.int32() if n == "ordinal" else pa.string()) for n in names])
    return spark.createDataFrame(pa.table({n: [r[i] for r in rows] for i, n in enumerate(names)}, schema=schema))
