"""Sinks: tables, point clouds, sidecars and promoted bundles."""

from __future__ import annotations

import json
import struct
import time
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship


def write_table(df: DataFrame, path: str) -> None:
    """CSV with a header or Parquet, by the path's ending."""
    (df.write.mode("overwrite").option("header", True).csv(path) if path.endswith(".csv") else df.write.mode("overwrite").parquet(path))


def write_bundle(tables: dict[str, DataFrame], folder: str, kind: str = "parquet") -> None:
    """Each table in a folder of its own name."""
    for name, df in tables.items():
        getattr(df.write.mode("overwrite"), kind)(f"{folder}/{name}")


_POINT = "<fffBBB"


def write_point_cloud(points: DataFrame, path: str) -> int:
    """A little-endian binary point cloud of (x, y, z, r, g, b); returns the number of points.

    Tasks write their points as parts in the shared store; the driver joins the parts by their bytes, without
    holding points. Points with a coordinate that is not finite are left out.
    """
    ship(points.sparkSession)
    store, root = fs.FileSystem.from_uri(path)
    folder = f"{root}.parts"
    store.create_dir(folder, recursive=True)
    ok = " and ".join(f"{c} is not null and not isnan({c}) and abs({c}) < 1e30" for c in "xyz")
    rows = points.where(ok).select(*[F.col(c).cast("float").alias(c) for c in "xyz"], *[F.col(c).cast("int").alias(c) for c in "rgb"])
    pattern, uri = _POINT, path

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, base = fs.FileSystem.from_uri(uri)
        t = TaskContext.get()
        name, n = f"{base}.parts/{t.partitionId():06d}", 0
        with s.open_output_stream(f"{name}.{t.taskAttemptId()}") as f:
            for b in batches:
                f.write(b"".join(struct.pack(pattern, *r) for r in zip(*(c.to_pylist() for c in b.columns))))
                n += b.num_rows
        s.move(f"{name}.{t.taskAttemptId()}", name)
        yield pa.record_batch([pa.array([n], pa.int64())], names=["n"])

    total = rows.mapInArrow(write, "n long").agg(F.sum("n")).first()[0] or 0
    head = f"ply\nformat binary_little_endian 1.0\nelement vertex {total}\n" + "".join(f"property float {c}\n" for c in "xyz") + "".join(f"property uchar {c}\n" for c in ("red", "green", "blue")) + "end_header\n"
    with store.open_output_stream(root) as out:
        out.write(head.encode())
        for info in sorted(store.get_file_info(fs.FileSelector(folder)), key=lambda i: i.path):
            if "." not in info.base_name:
                with store.open_input_stream(info.path) as f:
                    while chunk := f.read(1 << 22):
                        out.write(chunk)
    store.delete_dir(folder)
    return int(total)


def write_sidecar(associations: DataFrame, allowed: DataFrame, path: str, key: str = "point3d_id") -> None:
    """Write associations if all their points are among the allowed ones; else an error, and nothing is written."""
    stray = associations.where(F.col(key).isNotNull()).join(allowed.select(key), key, "left_anti").limit(5).collect()
    if stray:
        raise ValueError(f"unknown points: {[r[key] for r in stray]}")
    associations.write.mode("overwrite").parquet(path)


class BundleStore:
    """Versions of a bundle, a pointer to the current one, and a history of promotions. The pointer is swapped by a move."""

    def __init__(self, uri: str):
        self.store, self.root = fs.FileSystem.from_uri(uri)
        self.store.create_dir(self.root, recursive=True)

    def _read(self, name: str) -> str | None:
        if self.store.get_file_info(f"{self.root}/{name}").type == fs.FileType.NotFound:
            return None
        with self.store.open_input_stream(f"{self.root}/{name}") as f:
            return f.read().decode()

    def _swap(self, name: str, text: str) -> None:
        with self.store.open_output_stream(f"{self.root}/{name}.new") as f:
            f.write(text.encode())
        self.store.move(f"{self.root}/{name}.new", f"{self.root}/{name}")

    def current(self) -> str | None:
        got = self._read("current.json")
        return json.loads(got)["version"] if got else None

    def history(self) -> list[dict]:
        return [json.loads(x) for x in (self._read("history.jsonl") or "").splitlines()]

    def _point(self, version: str, action: str) -> None:
        rows = [*self.history(), {"version": version, "action": action, "before": self.current(), "time": time.time()}]
        self._swap("history.jsonl", "".join(json.dumps(r) + "\n" for r in rows))
        self._swap("current.json", json.dumps({"version": version}))

    def promote(self, version: str, report: dict, snapshot: str, expected_snapshot: str) -> None:
        """Point to a version whose report passes and whose snapshot is the expected one; else an error."""
        if report.get("status") != "PASS":
            raise ValueError("the regression report does not pass")
        if snapshot != expected_snapshot:
            raise ValueError("the snapshot has changed")
        self._point(version, "promote")

    def rollback(self, version: str | None = None) -> str:
        """Point to a version promoted before, the last one but the current if none is named."""
        known = [r["version"] for r in self.history() if r["action"] == "promote"]
        now = self.current()
        target = version or next((v for v in reversed(known) if v != now), None)
        if target is None or target not in known:
            raise ValueError("no version to go back to")
        self._point(target, "rollback")
        return target
