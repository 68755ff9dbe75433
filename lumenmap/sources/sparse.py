"""Sparse reconstructions, as text or binary files, read into five tables.

Files are opened by Spark's own readers (text, binaryFile), so any store that Spark reaches will do. A file is
one row of `binaryFile`; text tables are read by lines, images' two-line records being paired by the line's
place in its file.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import camera_centre, rotation_of_quaternion, view_direction
from ..session import ship

# The camera models' numbers, names and counts of parameters.
CAMERA_MODELS = {0: ("SIMPLE_PINHOLE", 3), 1: ("PINHOLE", 4), 2: ("SIMPLE_RADIAL", 4), 3: ("RADIAL", 5), 4: ("OPENCV", 8), 5: ("OPENCV_FISHEYE", 8), 6: ("FULL_OPENCV", 12), 7: ("FOV", 5), 8: ("SIMPLE_RADIAL_FISHEYE", 4), 9: ("RADIAL_FISHEYE", 5), 10: ("THIN_PRISM_FISHEYE", 12), 11: ("RAD_TAN_THIN_PRISM_FISHEYE", 16)}
NO_POINT = (1 << 64) - 1

CAMERAS = "camera_id long, model string, width long, height long, params array<double>"
IMAGES = "image_id long, qw double, qx double, qy double, qz double, tx double, ty double, tz double, camera_id long, name string, points array<struct<x:double,y:double,point3d_id:long>>"
POINTS = "point3d_id long, x double, y double, z double, r int, g int, b int, error double, track array<struct<image_id:long,point2d_idx:int>>"


def _camera_rows(data: bytes) -> Iterator[tuple]:
    (n,), at = struct.unpack_from("<Q", data), 8
    for _ in range(n):
        cid, model, w, h = struct.unpack_from("<iiQQ", data, at)
        name, k = CAMERA_MODELS[model]
        yield cid, name, w, h, list(struct.unpack_from(f"<{k}d", data, at + 24))
        at += 24 + 8 * k


def _image_rows(data: bytes) -> Iterator[tuple]:
    (n,), at = struct.unpack_from("<Q", data), 8
    for _ in range(n):
        iid, *pose, cid = struct.unpack_from("<i7di", data, at)
        at += 64
        end = data.index(b"\0", at)
        name = data[at:end].decode()
        (k,) = struct.unpack_from("<Q", data, end + 1)
        at = end + 9
        pts = [{"x": x, "y": y, "point3d_id": None if p == NO_POINT else p} for x, y, p in struct.iter_unpack("<ddQ", data[at : at + 24 * k])]
        at += 24 * k
        yield iid, *pose, cid, name, pts


def _point_rows(data: bytes) -> Iterator[tuple]:
    (n,), at = struct.unpack_from("<Q", data), 8
    for _ in range(n):
        pid, x, y, z, r, g, b, error, k = struct.unpack_from("<Q3d3BdQ", data, at)
        at += 51
        track = [{"image_id": i, "point2d_idx": j} for i, j in struct.iter_unpack("<ii", data[at : at + 8 * k])]
        at += 8 * k
        yield pid, x, y, z, r, g, b, error, track


_BINARY = {"cameras": (_camera_rows, CAMERAS), "images": (_image_rows, IMAGES), "points3D": (_point_rows, POINTS)}


def _binary(spark: SparkSession, path: str, name: str) -> DataFrame:
    parse, schema = _BINARY[name]
    kind = spark.createDataFrame([], schema)
    arrow = pa.schema(kind.toArrow().schema)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(0):
                held: list[tuple] = []
                for r in parse(content.as_py()):
                    held.append(r)
                    if len(held) == 5000:
                        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held), arrow)], schema=arrow)
                        held = []
                if held:
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held), arrow)], schema=arrow)

    return spark.read.format("binaryFile").load(f"{path}/{name}.bin").select("content").mapInArrow(rows, schema)


def _lines(spark: SparkSession, path: str, name: str) -> DataFrame:
    """(i, line) of a text file without comments; i counts lines. A file is one row until its lines are exploded."""
    text = spark.read.text(f"{path}/{name}.txt", wholetext=True)
    rows = text.select(F.posexplode(F.split(F.regexp_replace("value", "\r\n?", "\n"), "\n")).alias("i", "line"))
    return rows.where(~F.trim("line").startswith("#"))


def _text_cameras(spark: SparkSession, path: str) -> DataFrame:
    f = F.split(F.trim("line"), r"\s+")
    rows = _lines(spark, path, "cameras").where(F.trim("line") != "").select(f.alias("f"))
    return rows.select(F.col("f")[0].cast("long").alias("camera_id"), F.col("f")[1].alias("model"), F.col("f")[2].cast("long").alias("width"), F.col("f")[3].cast("long").alias("height"), F.slice("f", 5, 100).cast("array<double>").alias("params"))


def _text_images(spark: SparkSession, path: str) -> DataFrame:
    """Pairs of lines: the pose, then the observations (which may be empty).

    Casts are tries, as a filter on their results may run before the one that tells the lines apart.
    """
    from pyspark.sql import Window

    rows = _lines(spark, path, "images")
    pose = F.size(F.split(F.trim("line"), r"\s+")) >= 10
    w = Window.orderBy("i")  # one file of a model
    numbered = rows.withColumn("_pose", pose & F.trim("line").rlike(r"^\d+(\s+[-+0-9.eE]+){7}\s+\d+\s+\S")).withColumn("_next", F.lead("line").over(w)).where("_pose")
    numbered = numbered.withColumn("_odd", F.row_number().over(w))
    f = F.split(F.trim("line"), r"\s+", 10)
    rows = numbered.select(f.alias("f"), F.filter(F.split(F.trim(F.coalesce("_next", F.lit(""))), r"\s+"), lambda s: s != "").alias("o"))
    d = lambda i: F.col("f")[i].try_cast("double")
    n = F.floor(F.size("o") / 3).cast("int")
    points = F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda k: F.struct(F.get("o", k * 3).try_cast("double").alias("x"), F.get("o", k * 3 + 1).try_cast("double").alias("y"), F.when(F.get("o", k * 3 + 2).try_cast("long") >= 0, F.get("o", k * 3 + 2).try_cast("long")).alias("point3d_id"))))
    empty = F.array().cast("array<struct<x:double,y:double,point3d_id:long>>")
    return rows.select(F.col("f")[0].try_cast("long").alias("image_id"), *[d(i + 1).alias(c) for i, c in enumerate(("qw", "qx", "qy", "qz", "tx", "ty", "tz"))], F.col("f")[8].try_cast("long").alias("camera_id"), F.col("f")[9].alias("name"), F.coalesce(points, empty).alias("points"))


def _text_points(spark: SparkSession, path: str) -> DataFrame:
    f = F.split(F.trim("line"), r"\s+")
    rows = _lines(spark, path, "points3D").where(F.trim("line") != "").select(f.alias("f"))
    n = F.floor((F.size("f") - 8) / 2).cast("int")
    track = F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda k: F.struct(F.get("f", k * 2 + 8).cast("long").alias("image_id"), F.get("f", k * 2 + 9).cast("int").alias("point2d_idx"))))
    empty = F.array().cast("array<struct<image_id:long,point2d_idx:int>>")
    d = lambda i, c, t: F.col("f")[i].cast(t).alias(c)
    return rows.select(d(0, "point3d_id", "long"), d(1, "x", "double"), d(2, "y", "double"), d(3, "z", "double"), d(4, "r", "int"), d(5, "g", "int"), d(6, "b", "int"), d(7, "error", "double"), F.coalesce(track, empty).alias("track"))


def read_model(spark: SparkSession, path: str, kind: str = "auto") -> dict[str, DataFrame]:
    """cameras, images, observations, points and tracks of a model folder; kind: text, binary, or auto (binary if it is there).

    Images get their rotation (r_cw), shift (t_cw), centre and viewing direction; errors below 0 count as 0.
    """
    ship(spark)
    if kind == "auto":
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/images.bin")
        kind = "binary" if hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop) else "text"
    if kind == "binary":
        cameras, raw, points = (_binary(spark, path, n) for n in ("cameras", "images", "points3D"))
    else:
        cameras, raw, points = _text_cameras(spark, path), _text_images(spark, path), _text_points(spark, path)
    r, t = rotation_of_quaternion("qw", "qx", "qy", "qz"), F.array("tx", "ty", "tz")
    images = raw.withColumn("r_cw", r).withColumn("t_cw", t).withColumn("centre", camera_centre("r_cw", "t_cw")).withColumn("view_dir", view_direction("r_cw")).drop("points")
    observations = raw.select("image_id", F.posexplode("points").alias("point2d_idx", "p")).select("image_id", "point2d_idx", "p.*")
    tracks = points.select("point3d_id", F.explode("track").alias("t")).select("point3d_id", "t.*")
    points = points.drop("track").withColumn("error", F.greatest("error", F.lit(0.0)))
    return {"cameras": cameras, "images": images, "observations": observations, "points": points, "tracks": tracks}


def with_provenance(points: DataFrame, provenance: DataFrame) -> DataFrame:
    """points with a provenance column; BASE where there is none."""
    p = provenance.select("point3d_id", "provenance").dropDuplicates(["point3d_id"])
    return points.join(p, "point3d_id", "left").withColumn("provenance", F.coalesce("provenance", F.lit("BASE")))
