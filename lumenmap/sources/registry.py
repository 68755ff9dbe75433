"""Map adapters by name, model folders, evidence readers with aliases, and hooks for callables of the user."""

from __future__ import annotations

import importlib
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import clip, finite, first_finite
from .sparse import read_model
from .tables import read_rows

Adapter = Callable[[SparkSession, str], dict[str, DataFrame]]
_ADAPTERS: dict[str, Adapter] = {"sparse": read_model, "sparse_text": lambda s, p: read_model(s, p, "text"), "sparse_binary": lambda s, p: read_model(s, p, "binary")}


def register_adapter(name: str, adapter: Adapter, replace: bool = False) -> None:
    if not callable(adapter):
        raise TypeError("an adapter is a callable (spark, path)")
    if name in _ADAPTERS and not replace:
        raise ValueError(f"{name} is registered already")
    _ADAPTERS[name] = adapter


def adapter(name: str) -> Adapter:
    """A registered adapter, or the object that `module:attribute` names."""
    if name in _ADAPTERS:
        return _ADAPTERS[name]
    if ":" in name:
        module, _, attribute = name.partition(":")
        return getattr(importlib.import_module(module), attribute)
    raise KeyError(f"no adapter {name}; there are {sorted(_ADAPTERS)}")


def load_map(spark: SparkSession, path: str, name: str = "sparse") -> dict[str, DataFrame]:
    return adapter(name)(spark, path)


def find_model(spark: SparkSession, path: str) -> str:
    """The folder below a path whose file of points is the largest; ties by name. Files are listed, not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "points3D.*").load(path)
    folders = files.where(F.col("path").rlike(r"/points3D\.(bin|txt)$")).select(F.regexp_replace("path", r"/[^/]+$", "").alias("folder"), "length")
    best = folders.groupBy("folder").agg(F.max("length").alias("n")).orderBy(F.desc("n"), "folder").first()
    if best is None:
        raise FileNotFoundError(f"no model below {path}")
    return best["folder"]


def region_assignments(spark: SparkSession, path: str) -> DataFrame:
    """(query, region) from rows or from one object of queries; a query that is there twice is an error."""
    if path.endswith(".json"):
        text = spark.read.text(path, wholetext=True)
        as_rows = F.from_json("value", "array<struct<query:string,region:string>>")
        as_map = F.transform(F.map_entries(F.from_json("value", "map<string,string>")), lambda e: F.struct(e["key"].alias("query"), e["value"].alias("region")))
        rows = text.select(F.explode(F.when(F.trim("value").startswith("["), as_rows).otherwise(as_map)).alias("r")).select("r.query", "r.region")
    else:
        rows = read_rows(spark, path).select("query", "region")
    g = rows.groupBy("query").agg(F.min("region").alias("region"), F.count("*").alias("n"))
    return g.select(F.when(F.col("n") > 1, F.raise_error(F.concat(F.lit("query twice: "), "query"))).otherwise(F.col("query")).alias("query"), "region")


# Other names of columns.
IMAGE_ALIASES = {"name": ("image_name", "name", "image", "filename"), "sequence": ("route_id", "sequence", "session")}
NUMBER_ALIASES = {"x": ("x", "cx", "tx_world"), "y": ("y", "cy", "ty_world"), "z": ("z", "cz", "tz_world"), "timestamp": ("timestamp", "time", "ts"), "texture_score": ("texture_score", "texture")}


def image_rows(raw: DataFrame) -> DataFrame:
    """Image evidence with one name for each column; `registered` follows from a place where it is not given."""
    have = set(raw.columns)
    pick = lambda names: [F.col(f"`{c}`") for c in names if c in have]
    rows = raw.select(*[F.coalesce(*pick(v), F.lit(None)).cast("string").alias(k) for k, v in IMAGE_ALIASES.items()], *[first_finite(*pick(v), F.lit(None)).alias(k) for k, v in NUMBER_ALIASES.items()], (F.col("registered").cast("boolean") if "registered" in have else F.lit(None).cast("boolean")).alias("registered"))
    return rows.withColumn("registered", F.coalesce("registered", F.col("x").isNotNull() & F.col("y").isNotNull() & F.col("z").isNotNull()))


def hypotheses(spark: SparkSession, path: str) -> DataFrame:
    """(query_id, reference_id, x, y, z, covariance) of pose hypotheses; a covariance that is not of 9 finite numbers is null."""
    raw = read_rows(spark, path)
    c = F.col("covariance").cast("array<double>") if "covariance" in raw.columns else F.lit(None).cast("array<double>")
    ok = (F.size(c) == 9) & F.forall(c, lambda v: finite(v).isNotNull())
    return raw.select("query_id", F.col("reference_id").cast("string").alias("reference_id"), *[finite(k).alias(k) for k in "xyz"], F.when(ok, c).alias("covariance")).where("x is not null and y is not null and z is not null")


def retrieval_candidates(pairs: DataFrame) -> DataFrame:
    """(session_a, session_b, num_candidates): the most candidates that any payload names for a pair of sessions."""
    return pairs.where("session_a <> session_b").select(F.least("session_a", "session_b").alias("session_a"), F.greatest("session_a", "session_b").alias("session_b"), "num_candidates").groupBy("session_a", "session_b").agg(F.max("num_candidates").alias("num_candidates"))


def aligned_descriptors(descriptors: DataFrame, names: DataFrame, size: int) -> DataFrame:
    """Descriptors of exactly the expected names; a missing name or another length is an error."""
    j = names.select("name").distinct().join(descriptors.select("name", "descriptor"), "name", "left")
    bad = F.col("descriptor").isNull() | (F.size("descriptor") != size)
    return j.withColumn("descriptor", F.when(bad, F.raise_error(F.concat(F.lit("no descriptor of the right length: "), "name")).cast("array<float>")).otherwise(F.col("descriptor").cast("array<float>")))


# hooks


def predictor(call: Callable[[pd.DataFrame], pd.Series], low: float = 0.0, high: float = 1.0) -> Callable[..., Column]:
    """A callable over columns of a batch as a column function, its values clipped."""

    def column(*names: str) -> Column:
        @F.pandas_udf("double")
        def run(s: pd.DataFrame) -> pd.Series:
            return call(s).astype("float64")

        return clip(run(F.struct(*names)), low, high)

    return column


def matcher(pairs: DataFrame, call: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Rows that a callable makes of batches of pairs: retrievers, matchers, dense detectors."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield call(b)

    return pairs.mapInPandas(run, schema)


def run_protocol(specs: Sequence[dict], evaluate: Callable[[dict], DataFrame]) -> DataFrame:
    """The results of a fixed matrix of experiments, each with its name."""
    out = None
    for s in specs:
        r = evaluate(s).withColumn("experiment", F.lit(s["name"]))
        out = r if out is None else out.unionByName(r)
    return out
