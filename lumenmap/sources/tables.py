"""Contracts of evidence files: localisation results, manifests, histories, pairs, edges, databases."""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from ..functions.exprs import finite, first_finite, pair_ids, parse_bool
from ..operators.windows import merge_last

RESULT_METRICS = ("inliers", "inlier_ratio", "reproj_p90_px", "hull_coverage", "grid4_occupancy", "positive_depth_ratio", "pose_consensus", "x", "y", "z", "position_error_m", "rotation_error_deg")
# Other names that columns go by.
ALIASES = {
    "image_i": ("image_i", "image1", "name1", "a"),
    "image_j": ("image_j", "image2", "name2", "b"),
    "num_matches": ("num_matches", "matches", "raw_matches"),
    "num_inliers": ("num_inliers", "inliers", "verified_matches"),
    "retrieval_score": ("retrieval_score", "score", "similarity"),
}


def read_rows(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, JSON (a list) or JSON lines, Parquet: by the path's ending. CSV columns are text."""
    if path.endswith(".csv"):
        return spark.read.option("header", True).option("mode", "FAILFAST").csv(path)
    if path.endswith((".jsonl", ".ndjson")):
        return spark.read.json(path)
    if path.endswith(".json"):
        return spark.read.option("multiLine", True).json(path)
    return spark.read.parquet(path)


def results(spark: SparkSession, path: str, unique: bool = True) -> DataFrame:
    """Localisation results: query and success are required; other columns go into the map `metrics`.

    A word that is no boolean, a blank query and, if unique, a repeated one are errors.
    """
    raw = read_rows(spark, path)
    missing = {"query", "success"} - set(raw.columns)
    if missing:
        raise ValueError(f"columns are missing: {sorted(missing)}")
    rest = [c for c in raw.columns if c not in {*RESULT_METRICS, "query", "success", "localizer", "metrics"}]
    blank = F.trim(F.coalesce("query", F.lit(""))) == ""
    cols = [F.when(blank, F.raise_error(F.lit("a query has no name"))).otherwise(F.col("query")).alias("query"), parse_bool("success").alias("success")]
    cols.append((F.coalesce(F.nullif("localizer", F.lit("")), F.lit("unspecified")) if "localizer" in raw.columns else F.lit("unspecified")).alias("localizer"))
    cols += [(finite(F.expr(f"try_cast(`{c}` as double)")) if c in raw.columns else F.lit(None).cast("double")).alias(c) for c in RESULT_METRICS]
    pairs = [x for c in rest for x in (F.lit(c), F.col(f"`{c}`").cast("string"))]
    cols.append((F.map_filter(F.create_map(*pairs), lambda k, v: v.isNotNull()) if pairs else F.create_map().cast("map<string,string>")).alias("metrics"))
    out = raw.select(*cols)
    if unique:
        counts = out.groupBy("query").agg(F.count("*").alias("_n"))
        out = out.join(counts, "query").withColumn("query", F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit("query twice: "), "query"))).otherwise(F.col("query"))).drop("_n")
    return out


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The ordered queries of a text file (# begins a comment) or of JSON ({queries} or a list of strings)."""
    if path.endswith(".json"):
        text = spark.read.text(path, wholetext=True)
        listed = F.coalesce(F.from_json("value", "struct<queries:array<string>>")["queries"], F.from_json("value", "array<string>"))
        rows = text.select(F.posexplode(listed).alias("i", "query"))
    else:
        text = spark.read.text(path, wholetext=True)
        rows = text.select(F.posexplode(F.split("value", r"\r?\n")).alias("i", "line")).select("i", F.trim(F.regexp_replace("line", "#.*$", "")).alias("query")).where("query <> ''")
    return rows.groupBy("query").agg(F.min("i").alias("i"), F.count("*").alias("n")).select("i", F.when(F.col("n") > 1, F.raise_error(F.concat(F.lit("query twice: "), "query"))).otherwise(F.col("query")).alias("query"))


def risk_scores(spark: SparkSession, path: str) -> DataFrame:
    """(query, risk) with risk in [0, 1], else an error."""
    r = read_rows(spark, path).select("query", F.col("risk").cast("double").alias("risk"))
    bad = F.col("risk").isNull() | F.isnan("risk") | (F.col("risk") < 0) | (F.col("risk") > 1)
    return r.withColumn("risk", F.when(bad, F.raise_error(F.concat(F.lit("risk out of range: "), "query")).cast("double")).otherwise(F.col("risk")))


def history(spark: SparkSession, path: str, metrics: Sequence[str] = ("inliers", "inlier_ratio", "reproj_p90", "registration_confidence")) -> DataFrame:
    """Pose-tagged records: x, y and z must be finite; the viewing direction follows from a quaternion where there is one."""
    raw = read_rows(spark, path)
    num = lambda c: finite(F.expr(f"try_cast(`{c}` as double)"))
    out = raw.select(*[num(c).alias(c) for c in ("x", "y", "z")], *[(num(c) if c in raw.columns else F.lit(None).cast("double")).alias(c) for c in ("qx", "qy", "qz", "qw", *metrics)], (parse_bool("success") if "success" in raw.columns else F.lit(None).cast("boolean")).alias("success"))
    x, y, z, w = (F.col(c) for c in ("qx", "qy", "qz", "qw"))
    n = x * x + y * y + z * z + w * w
    forward = F.when(n > 0, F.array(2 * (x * z + w * y) / n, 2 * (y * z - w * x) / n, 1 - 2 * (x * x + y * y) / n))
    return out.where("x is not null and y is not null and z is not null").withColumn("forward", forward)


def pair_rows(raw: DataFrame) -> DataFrame:
    """Pairs with one name for each column, ends in order, and the ratio of inliers; pairs with themselves go."""
    have = set(raw.columns)
    pick = lambda names: [F.col(f"`{c}`") for c in names if c in have]
    text = {k: F.coalesce(*pick(ALIASES[k]), F.lit(None)).cast("string") for k in ("image_i", "image_j")}
    nums = {k: first_finite(*pick(ALIASES[k]), F.lit(None)) for k in ("num_matches", "num_inliers", "retrieval_score")}
    rows = raw.select(*[v.alias(k) for k, v in text.items()], *[v.alias(k) for k, v in nums.items()])
    rows = rows.where("image_i <> image_j").select(F.least("image_i", "image_j").alias("image_i"), F.greatest("image_i", "image_j").alias("image_j"), *nums)
    return rows.withColumn("inlier_ratio", F.expr("try_divide(num_inliers, num_matches)"))


def merge_pairs(parts: Sequence[DataFrame]) -> DataFrame:
    """One row for each pair; later parts' values win where they have any."""
    fields = ("num_matches", "num_inliers", "retrieval_score", "inlier_ratio")
    rows = None
    for i, p in enumerate(parts):
        r = pair_rows(p).withColumn("_order", F.lit(i))
        rows = r if rows is None else rows.unionByName(r)
    return merge_last(rows, ["image_i", "image_j"], "_order", fields)


# SQLite


class _Range(InputPartition):
    def __init__(self, low: int, high: int):
        self.low, self.high = low, high


class _SqliteReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.schema, self.path, self.table = schema, options["path"], options["table"]
        self.parts = int(options.get("partitions", "1"))
        self.columns = [f.name for f in schema.fields]

    def _connect(self) -> sqlite3.Connection:
        return sqlite3.connect(f"file:{self.path}?mode=ro&immutable=1", uri=True)

    def partitions(self) -> Sequence[InputPartition]:
        with self._connect() as c:
            low, high = c.execute(f'select min(rowid), max(rowid) from "{self.table}"').fetchone()
        if low is None:
            return [_Range(0, 0)]
        step = -(-(high - low + 1) // self.parts)
        return [_Range(a, min(high + 1, a + step)) for a in range(low, high + 1, step)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        names = ", ".join(f'"{c}"' for c in self.columns)
        with self._connect() as c:
            yield from c.execute(f'select {names} from "{self.table}" where rowid >= ? and rowid < ?', (partition.low, partition.high))


class SqliteSource(DataSource):
    """A table of an SQLite file, read only, by ranges of row ids. Only the columns of the given schema are read.

    The path must be one that the executors can open.
    """

    @classmethod
    def name(cls) -> str:
        return "lumenmap_sqlite"

    def schema(self) -> str:
        raise ValueError("give the schema of the columns to read")

    def reader(self, schema: StructType) -> DataSourceReader:
        return _SqliteReader(schema, self.options)


def read_sqlite(spark: SparkSession, path: str, table: str, schema: str, partitions: int = 1) -> DataFrame:
    from ..session import ship

    ship(spark)
    spark.dataSource.register(SqliteSource)
    return spark.read.format("lumenmap_sqlite").schema(schema).option("path", path).option("table", table).option("partitions", str(partitions)).load()


def database_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Matches and verified pairs of a database, with names, and the ratio of inliers."""
    images = read_sqlite(spark, path, "images", "image_id long, name string")
    m = read_sqlite(spark, path, "matches", "pair_id long, rows long").toDF("pair_id", "num_matches")
    v = read_sqlite(spark, path, "two_view_geometries", "pair_id long, rows long").toDF("pair_id", "num_inliers")
    i, j = pair_ids("pair_id")
    p = m.join(v, "pair_id", "full_outer").withColumn("i", i).withColumn("j", j)
    p = p.join(images.toDF("i", "image_i"), "i", "left").join(images.toDF("j", "image_j"), "j", "left")
    return p.select("pair_id", "image_i", "image_j", "num_matches", F.coalesce("num_inliers", F.lit(0)).cast("long").alias("num_inliers"), F.expr("try_divide(coalesce(num_inliers, 0), num_matches)").alias("inlier_ratio"))


def images_without_keypoints(spark: SparkSession, path: str) -> DataFrame:
    images = read_sqlite(spark, path, "images", "image_id long, name string")
    keypoints = read_sqlite(spark, path, "keypoints", "image_id long, rows long").where("rows > 0")
    return images.join(keypoints, "image_id", "left_anti")


def media_index(spark: SparkSession, path: str, pattern: str = r"([^/]+)/([^/]+?)_?(\d+)\.[A-Za-z]+$") -> DataFrame:
    """(path, bytes, session, sequence, frame) of the files below a folder, from their names; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", F.col("length").alias("bytes"))
    g = lambda k: F.nullif(F.regexp_extract("path", pattern, k), F.lit(""))
    return files.select("path", "bytes", g(1).alias("session"), g(2).alias("sequence"), g(3).cast("long").alias("frame"))


def content_hashes(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", F.sha2("content", 256).alias("sha256"))


# precomputed matches

MATCHES = "query_id string, reference_id string, match_id long, q_x double, q_y double, r_x double, r_y double, confidence double"


def _match_rows(path: str, content: bytes) -> list[tuple]:
    import io

    import numpy as np

    query, _, reference = path.rsplit("/", 1)[-1].removesuffix(".npz").partition("__")
    with np.load(io.BytesIO(content), allow_pickle=False) as f:
        q, r = np.asarray(f["query_xy"], float), np.asarray(f["reference_xy"], float)
        c = np.asarray(f["confidence"], float) if "confidence" in f else np.ones(len(q))
    if q.shape != r.shape or q.ndim != 2 or q.shape[1] != 2 or len(c) != len(q):
        raise ValueError(f"{path}: the arrays do not fit together")
    return [(query, reference, i, *map(float, (*q[i], *r[i])), float(c[i])) for i in range(len(q))]


def precomputed_matches(spark: SparkSession, path: str, swap: bool = False) -> DataFrame:
    """Matches of `query__reference.npz` files (query_xy, reference_xy, confidence); swap turns query and reference round."""
    import pandas as pd

    from ..session import ship

    ship(spark)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in MATCHES.split(", ")]
        for b in batches:
            for p, content in zip(b["path"], b["content"]):
                yield pd.DataFrame(_match_rows(p, content), columns=names)

    rows = spark.read.format("binaryFile").option("pathGlobFilter", "*.npz").load(path).select("path", "content").mapInPandas(read, MATCHES)
    if swap:
        rows = rows.select(F.col("reference_id").alias("query_id"), F.col("query_id").alias("reference_id"), "match_id", F.col("r_x").alias("q_x"), F.col("r_y").alias("q_y"), F.col("q_x").alias("r_x"), F.col("q_y").alias("r_y"), "confidence")
    return rows
