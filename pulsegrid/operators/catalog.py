"""Catalogue work: joins, reconciliation, duplicates, coverage, selection and incremental steps."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Rows of ``child`` whose key no row of ``parent`` has; null keys among them."""
    return child.join(parent, child[child_key] == parent[parent_key], "left_anti")


def new_rows(rows: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that ``existing`` doesn't hold by ``keys``; null equals null, so that inserts can be repeated."""
    e = existing.select(*[F.col(k).alias(f"__{k}") for k in keys])
    condition = None
    for k in keys:
        one = F.col(k).eqNullSafe(F.col(f"__{k}"))
        condition = one if condition is None else condition & one
    return rows.join(e, condition, "left_anti")


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row per key by an explicit order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__first", F.row_number().over(w)).where("__first = 1").drop("__first")


def content_duplicates(files: DataFrame, path: str, digest: str) -> DataFrame:
    """Column ``duplicate_of``: the first path with the same content, null for that path itself."""
    first = files.groupBy(digest).agg(F.min(path).alias("__first"))
    return files.join(first, digest).withColumn("duplicate_of", F.when(F.col(path) != F.col("__first"), F.col("__first"))).drop("__first")


def chain_hash(files: DataFrame, key: str, digest: str) -> DataFrame:
    """One hash per chain of slices, from the sorted hashes of the slices."""
    joined = F.array_join(F.array_sort(F.collect_list(digest)), "")
    return files.groupBy(key).agg(F.count("*").alias("n_slices"), F.sha2(joined, 256).alias("chain_sha256"))


def reconcile(source: DataFrame, target: DataFrame, path: str, size: str, digest: str) -> DataFrame:
    """Where each source file is in the target: by content and size, else by path; then what the target alone has.

    status MATCHED, MATCHED_SIZE (same path and size, contents unknown), CONFLICT, MISSING or TARGET_ONLY and the action
    that follows.
    """
    by_content = target.groupBy(F.col(digest).alias("__d"), F.col(size).alias("__s")).agg(F.min(path).alias("content_path"))
    by_path = target.select(F.col(path).alias("__p"), F.col(size).alias("path_size"), F.col(digest).alias("path_digest"))
    rows = source.join(by_content, (F.col(digest) == F.col("__d")) & (F.col(size) == F.col("__s")), "left")
    rows = rows.join(by_path, F.col(path) == F.col("__p"), "left")
    status = (
        F.when(F.col("content_path").isNotNull(), "MATCHED")
        .when(F.col("__p").isNull(), "MISSING")
        .when((F.col("path_size") == F.col(size)) & (F.col("path_digest").isNull() | F.col(digest).isNull()), "MATCHED_SIZE")
        .otherwise("CONFLICT")
    )
    out = rows.select(path, F.coalesce("content_path", "__p").alias("target_path"), status.alias("status"))
    seen = out.where("target_path is not null").select(F.col("target_path").alias("__seen")).distinct()
    rest = target.join(seen, F.col(path) == F.col("__seen"), "left_anti")
    rest = rest.select(F.col(path), F.col(path).alias("target_path"), F.lit("TARGET_ONLY").alias("status"))
    action = F.when(F.col("status") == "MISSING", "upload").when(F.col("status") == "CONFLICT", "conflict").when(F.col("status") == "TARGET_ONLY", "review")
    return out.unionByName(rest).withColumn("action", action.otherwise("none"))


def mirror_status(main: DataFrame, nested: DataFrame, path: str, size: str, digest: str) -> DataFrame:
    """Files of two mirrors by path: only in one, other size, other content or identical."""
    a = main.select(F.col(path), F.col(size).alias("a_size"), F.col(digest).alias("a_digest"))
    b = nested.select(F.col(path), F.col(size).alias("b_size"), F.col(digest).alias("b_digest"))
    status = (
        F.when(F.col("b_size").isNull(), "ONLY_IN_MAIN")
        .when(F.col("a_size").isNull(), "ONLY_IN_NESTED")
        .when(F.col("a_size") != F.col("b_size"), "SIZE_MISMATCH")
        .when(F.col("a_digest") != F.col("b_digest"), "HASH_MISMATCH")
        .otherwise("IDENTICAL")
    )
    return a.join(b, path, "full").select(path, status.alias("status"))


def plan_collisions(moves: DataFrame, target: str, digest: str, origin: str) -> DataFrame:
    """Moves that share a target: equal contents are duplicates of the first, different ones are conflicts."""
    w = Window.partitionBy(target)
    several = F.min(digest).over(w) != F.max(digest).over(w)
    first = F.row_number().over(Window.partitionBy(target).orderBy(origin)) == 1
    return moves.withColumn("status", F.when(several, "conflict").when(first, "move").otherwise("duplicate"))


def to_process(files: DataFrame, state: DataFrame, path: str, revision: str) -> DataFrame:
    """Files that are new, changed or failed before; unsupported and unchanged ones are skipped.

    state: path, revision, status of what was processed.
    """
    s = state.select(F.col(path).alias("__p"), F.col(revision).alias("__r"), F.col("status").alias("__s"))
    rows = files.join(s, F.col(path) == F.col("__p"), "left")
    same = F.col("__r").eqNullSafe(F.col(revision))
    skip = same & F.col("__s").isin("ok", "unsupported")
    return rows.where(~F.coalesce(skip, F.lit(False))).drop("__p", "__r", "__s")


def sync_action(files: DataFrame, state: DataFrame, path: str, digest: str) -> DataFrame:
    """skip what is stored with the same content, store a new version of what changed, store what is new."""
    s = state.select(F.col(path).alias("__p"), F.col(digest).alias("__d"))
    action = F.when(F.col("__p").isNull(), "new").when(F.col("__d") == F.col(digest), "skip").otherwise("version")
    return files.join(s, F.col(path) == F.col("__p"), "left").withColumn("action", action).drop("__p", "__d")


def latest(df: DataFrame, keys: list[str], position: str) -> DataFrame:
    """The last entry of a log per key."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), position).alias("e")).select(*keys, "e.*")


def budget_prefix(df: DataFrame, scope: list[str], order: str, size: str, budget: int) -> DataFrame:
    """The files in order whose sizes add up to the budget at most; the first one in any case."""
    w = Window.partitionBy(*scope).orderBy(order)
    rows = df.withColumn("running", F.sum(size).over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("__k", F.row_number().over(w))
    return rows.where((F.col("running") <= budget) | (F.col("__k") == 1)).drop("__k")


def size_chunks(df: DataFrame, scope: list[str], order: str, size: str, limit: int) -> DataFrame:
    """Column ``chunk``: files in order, a new chunk where the limit would be passed; an oversize file is alone.

    Each scope is streamed in order through one task, whose only state is the current chunk and what it holds, so a scope
    of any length passes in linear time; scopes run in parallel. Each row comes out once; rows without an order are last.
    """
    rows = df.repartition(*scope).sortWithinPartitions(*scope, F.col(order).asc_nulls_last(), size)
    at_keys, at_size = [df.columns.index(c) for c in scope], df.columns.index(size)
    schema = T.StructType([*df.schema.fields, T.StructField("chunk", T.IntegerType())])

    def run(batches):
        scope, used, chunk = None, 0, -1
        for batch in batches:
            keys = zip(*[batch.column(i).to_pylist() for i in at_keys], strict=True)
            out = []
            for key, n in zip(keys, batch.column(at_size).to_pylist(), strict=True):
                if key != scope:
                    scope, used, chunk = key, 0, -1
                # As in SQL, an unknown sum is not over the limit.
                total = None if used is None or n is None else used + n
                fresh = chunk < 0 or (total is not None and total > limit)
                used, chunk = (n, chunk + 1) if fresh else (total, chunk)
                out.append(chunk)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int32())], schema.names)

    return rows.mapInArrow(run, schema)


def chunk_matrix(df: DataFrame, scope: list[str], order: str, k: int) -> DataFrame:
    return df.withColumn("chunk", F.floor((F.row_number().over(Window.partitionBy(*scope).orderBy(order)) - 1) / k))


def decimate(df: DataFrame, keys: list[str], order: str, above: int, most: int) -> DataFrame:
    """Every step-th row of series longer than ``above``; the step keeps about ``most`` rows."""
    n = F.count("*").over(Window.partitionBy(*keys))
    i = F.row_number().over(Window.partitionBy(*keys).orderBy(order)) - 1
    step = F.when(F.col("__n") > above, F.ceil(F.col("__n") / most)).otherwise(1)
    return df.withColumn("__n", n).withColumn("__i", i).where(F.col("__i") % step == 0).drop("__n", "__i")


def group_cap(df: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    """At most ``k`` rows per key, by an order."""
    return df.withColumn("__k", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("__k") <= k).drop("__k")


def uncertainty_queue(df: DataFrame, probability: str, ident: str, low: float = 0.2, high: float = 0.7, check_share: int = 20) -> DataFrame:
    """What to review first: uncertain rows by distance from one half, and every ``check_share``-th sure one by hash."""
    p = F.col(probability)
    uncertain = p.between(low, high)
    spot = (p > high) & (F.col(ident) % check_share == 0)
    out = df.where(uncertain | spot).withColumn("reason", F.when(uncertain, "uncertain").otherwise("spot_check"))
    return out.withColumn("distance", F.abs(p - 0.5)).orderBy("distance", ident)


def presence_pivot(df: DataFrame, item: str, column: str, columns: list[str]) -> DataFrame:
    """YES where an item occurs under a column, else an empty text."""
    wide = df.select(item, column).distinct().groupBy(item).pivot(column, columns).agg(F.first(F.lit("YES")))
    return wide.fillna("", columns)


def tree_counts(files: DataFrame, path: str) -> DataFrame:
    """Files under every folder."""
    parts = F.split(path, "/")
    prefixes = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    rows = files.where(F.size(parts) > 1).select(F.explode(prefixes).alias("folder"))
    return rows.groupBy("folder").agg(F.count("*").alias("n_files"))


def schema_census(columns: DataFrame, unit: str, name: str) -> DataFrame:
    """How many units have each column and whether all do; a column not in all of them is drift."""
    total = columns.agg(F.countDistinct(unit).alias("__total"))
    out = columns.groupBy(name).agg(F.countDistinct(unit).alias("n_units")).crossJoin(F.broadcast(total))  # one row
    out = out.withColumn("stability", F.col("n_units") / F.col("__total"))
    return out.withColumn("drift", F.col("n_units") < F.col("__total")).drop("__total")
