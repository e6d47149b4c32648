"""What the operators share: scratch tables, joins that bear hot keys, ranks and components.

Scratch tables go below ``spark.checkpoint.dir``, the folder that the driver and all executors
share, so a lost executor costs a re-run of some tasks and never a lost intermediate result.
"""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import threading
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

_local_roots: dict[str, str] = {}
_swept: set[str] = set()
_thread = threading.local()


def _scopes() -> list[list[str]]:
    """The open scopes of temporary(), of this thread alone: two queries in threads keep apart."""
    if not hasattr(_thread, "scopes"):
        _thread.scopes = []
    return _thread.scopes


def scratch_root(spark: SparkSession) -> str:
    """The shared scratch folder; a temporary one only where none is set and Spark runs in one JVM."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all executors share")
        folder = tempfile.TemporaryDirectory(prefix="mapforge-")
        atexit.register(folder.cleanup)
        _local_roots[app] = f"file://{folder.name}"
    return _local_roots[app]


def _hadoop(spark: SparkSession, path: str):
    """(its file system, its path) by Hadoop."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh path below the shared scratch folder, in a folder of the application that goes when its driver ends."""
    folder = f"{scratch_root(spark)}/mapforge/{spark.sparkContext.applicationId}"
    if folder not in _swept:
        fs, at = _hadoop(spark, folder)
        fs.mkdirs(at)
        fs.deleteOnExit(at)
        _swept.add(folder)
    return f"{folder}/{tag}-{uuid.uuid4().hex}"


def whole_texts(spark: SparkSession, rows: int = 512) -> None:
    """Lower the session's Arrow batches to ``rows``: rows here are whole texts, and a batch is in memory on both sides of a Python worker."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


@contextlib.contextmanager
def temporary(spark: SparkSession):
    """Tables written inside are deleted at the end, but for those written with keep: nothing returned may read the others."""
    paths: list[str] = []
    _scopes().append(paths)
    try:
        yield
    finally:
        _scopes().pop()
        for path in paths:
            drop_path(spark, path)


def drop_path(spark: SparkSession, path: str) -> None:
    fs, at = _hadoop(spark, path)
    fs.delete(at, True)


def written(df: DataFrame, tag: str, keep: bool = False) -> DataFrame:
    """df as a table in the shared scratch folder: computed once, and its lineage ends there.

    Inside temporary() the table goes when that ends; with keep it goes with the next scope outside, if there is one.
    """
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    scopes = _scopes()
    for scope in scopes[-2:-1] if keep else scopes[-1:]:
        scope.append(path)
    whole_texts(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def measured(df: DataFrame, tag: str, *values: Column, keep: bool = False) -> tuple[DataFrame, dict]:
    """written() and its number of rows (n) and other aggregates, gathered while it is written: no job of their own."""
    seen = Observation()
    out = written(df.observe(seen, F.count(F.lit(1)).alias("n"), *values), tag, keep)
    return out, seen.get


def dropped(table: DataFrame) -> None:
    """Delete the files of a written table that nothing reads any more."""
    for path in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        drop_path(table.sparkSession, path)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps now.

    It does so when the driver's garbage collection finds their plans gone, which may be long after the step; the files
    of a whole operator would lie on the executors' disks together.
    """
    spark.sparkContext._jvm.System.gc()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def unit_interval(h: Column) -> Column:
    """A 64-bit hash as a double in [0, 1): its upper 53 bits."""
    return F.shiftrightunsigned(h, 11).cast("double") / F.lit(float(1 << 53))


def ranked(df: DataFrame, group: list[str], hashed: str, ties: list[str], weight: str | None = None) -> DataFrame:
    """Add ``rank`` (from 0) and, with weight, ``before`` (the sum of weight over lower ranks) per group.

    The order is that of the 64-bit hash column, then ties. No group meets in one task: a group of
    n rows is dealt by hash into about sqrt(n) buckets, buckets are summed, the sums are accumulated
    per group, and rows are ranked inside their bucket. So hot groups cost what others cost.
    """
    w = F.col(weight) if weight else F.lit(0).cast("long")
    same = [F.col(f"n.{g}").eqNullSafe(F.col(f"d.{g}")) for g in group]
    cond = same[0]
    for c in same[1:]:
        cond = cond & c
    sizes = df.groupBy(*group).agg(F.ceil(F.sqrt(F.count(F.lit(1)))).alias("__buckets"))
    dealt = (
        df.alias("d").join(sizes.alias("n"), cond).select("d.*", F.floor(unit_interval(F.col(f"d.{hashed}")) * F.col("n.__buckets")).cast("long").alias("__bucket"))
    )
    dealt = dealt.select("*", F.shiftrightunsigned(F.col(hashed), 11).alias("__pos"))
    sums = dealt.groupBy(*group, "__bucket").agg(F.count(F.lit(1)).alias("__n"), F.sum(w).alias("__w"))
    upto = Window.partitionBy(*group).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*group, "__bucket", F.coalesce(F.sum("__n").over(upto), F.lit(0)).alias("__n0"), F.coalesce(F.sum("__w").over(upto), F.lit(0)).alias("__w0"))
    inside = Window.partitionBy(*group, "__bucket").orderBy("__pos", *ties)
    rows = dealt.withColumns({
        "__r": F.row_number().over(inside) - 1,
        "__b": F.coalesce(F.sum(w).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    })
    cond = F.col("n.__bucket") == F.col("d.__bucket")
    for c in same:
        cond = cond & c
    out = rows.alias("d").join(starts.alias("n"), cond)
    cols = [F.col(f"d.{c}") for c in df.columns] + [(F.col("n.__n0") + F.col("d.__r")).cast("long").alias("rank")]
    if weight:
        cols.append((F.col("n.__w0") + F.col("d.__b")).cast("long").alias("before"))
    return out.select(*cols)


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the smallest node id reachable, for every node that has an edge.

    Alternating large-star and small-star contraction; each is a written table, whose number and hash
    tell when nothing changes. A node's least neighbour is aggregated before the shuffle and brought to
    its edges by lookup(), so a hub's edges are dealt evenly. No edges: no rows.
    """
    with temporary(edges.sparkSession):
        return written(_components(edges, a, b), "components", keep=True)


def _components(edges: DataFrame, a: str, b: str) -> DataFrame:
    x, y = F.col(a).cast("long"), F.col(b).cast("long")
    state = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")
    cur, now = measured(edges.where(x != y).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct(), "edges", state)
    seen = None
    while now["n"] and now != seen:
        seen = now
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"), F.count(F.lit(1)).alias("c"))
        met = lookup(both, least, "u", "c", 2 * now["n"])
        large, now = measured(met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large-star", state)
        down = large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("c"))
        low = lookup(large, down, "u", "c", now["n"])
        small = low.select(F.when(F.col("v") != F.col("m"), F.col("v")).otherwise(F.col("u")).alias("u"), F.col("m").alias("v")).distinct()
        cur, now = measured(small, "small-star", state)
    return cur.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(cur.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def let(value: Column, use) -> Column:
    """use(value) with value computed once: inside higher-order functions Catalyst would else copy it."""
    return F.transform(F.array(value), use)[0]


def lookup(left: DataFrame, right: DataFrame, key: str, n: str, total: int) -> DataFrame:
    """left with right's columns by key (null where it has none); right has a row per key (a long or string) and n, left's rows of that key.

    Keys with more than a thousandth of all rows (fewer than a thousand, so they are broadcast) are
    looked up on the map side; their rows are then dealt evenly in the shuffled join for all others.
    """
    values = [c for c in right.columns if c not in (key, n)]
    kind = left.schema[key].dataType
    hot = right.where(F.col(n) * 1000 > total).select(F.col(key).alias("__hot"), F.struct(*values).alias("__hot_v"))
    rest = right.where(F.col(n) * 1000 <= total).select(F.col(key).cast(kind).alias("__rest"), F.struct(*values).alias("__rest_v"))
    rows = left.join(F.broadcast(hot), F.col(key) == F.col("__hot"), "left")
    # Rows that need no key any more (hot, or null) get one of their hash; what it may meet by chance is not used.
    spread = F.xxhash64(F.lit(17), *[c for c in left.columns if c != key])
    done = F.col("__hot").isNotNull() | F.col(key).isNull()
    rows = rows.withColumn("__key", F.when(done, spread.cast(kind)).otherwise(F.col(key)))
    rows = rows.join(rest, F.col("__key") == F.col("__rest"), "left")
    rows = rows.withColumn("__v", F.when(done, F.col("__hot_v")).otherwise(F.col("__rest_v")))
    return rows.select(*left.columns, *[F.col(f"__v.{c}").alias(c) for c in values])


#: Rows of a table of bits that is broadcast (4 MB, whatever the input), and 64-bit words in each.
_BIT_ROWS, _BIT_WORDS = 8192, 64


def maybe_among(rows: DataFrame, keys: DataFrame, hashed: str, name: str) -> DataFrame:
    """rows with a boolean column name: false where no row of keys has the same 64-bit hash, else nearly always true.

    The hashes set bits of a table of fixed size, which is broadcast; so rows that can have no partner in keys are
    told from the others without a shuffle. The more keys, the more others are true as well: it only spares work.
    """
    def place(df: DataFrame) -> tuple[Column, Column, Column]:
        h = F.pmod(df[hashed], F.lit(_BIT_ROWS * _BIT_WORDS * 64))
        return (h % _BIT_ROWS).cast("int"), (F.floor(h / _BIT_ROWS) % _BIT_WORDS).cast("int"), F.floor(h / (_BIT_ROWS * _BIT_WORDS)).cast("int")

    row, word, bit = place(keys)
    # One 64-bit word a group; both steps add up before their shuffle.
    words = keys.select(row.alias("__row"), word.alias("__word"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("__bit")).groupBy("__row", "__word").agg(F.bit_or("__bit").alias("__bits"))
    table = words.groupBy("__row").agg(F.map_from_entries(F.collect_list(F.struct("__word", "__bits"))).alias("__words"))
    row, word, bit = place(rows)
    met = rows.withColumns({"__at": row, "__w": word, "__b": bit}).join(F.broadcast(table), F.col("__at") == F.col("__row"), "left")
    hit = F.coalesce(F.call_function("shiftright", F.try_element_at("__words", F.col("__w")), F.col("__b")).bitwiseAND(F.lit(1)) == 1, F.lit(False))
    return met.select(*rows.columns, hit.alias(name))


def with_text(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The documents in column row with their text replaced by column text, and n_chars (if they have it) counted anew."""
    new = {"text": F.col("text"), "n_chars": F.char_length("text").cast("long")}
    return rows.select(*[(new[c] if c in new else F.col("row").getField(c)).alias(c) for c in columns])
