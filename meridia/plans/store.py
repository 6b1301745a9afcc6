"""Where wikis' data lie: generations under one pointer, datasets that change whole, receipts. All through Hadoop's file systems.

``data``/warehouse/<wiki>/<version>: a generation; ``active.json`` beside them names the one in use. ``data``/patrol/<wiki>:
patrol and rights events, groups. ``out``/<wiki>/<dataset>: datasets of a wiki; ``out``/<dataset>: merged ones. A dataset is
written beside its place and then moved there, so readers see the old or the new one.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from meridia.plans.contracts import VERSION


class Store:
    def __init__(self, spark: SparkSession, data: str, out: str):
        self.spark, self.data, self.out = spark, data.rstrip("/"), out.rstrip("/")

    def _at(self, path: str):
        java = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return java, java.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        java, fs = self._at(path)
        return fs.exists(java)

    def delete(self, path: str) -> None:
        java, fs = self._at(path)
        fs.delete(java, True)

    def move(self, path: str, to: str) -> None:
        java, fs = self._at(path)
        target = self._at(to)[0]
        fs.mkdirs(target.getParent())
        if not fs.rename(java, target):
            raise OSError(f"cannot move {path} to {to}")

    def folders(self, path: str) -> list[str]:
        """Names of the folders in a folder, in order, without hidden ones."""
        java, fs = self._at(path)
        found = [s.getPath().getName() for s in fs.listStatus(java) if s.isDirectory()] if fs.exists(java) else []
        return sorted(n for n in found if n[0] not in "._")

    def files(self, path: str) -> list[tuple[str, int, int]]:
        """(name, bytes, time) of all files below, in order of their names; hidden ones and markers left out."""
        java, fs = self._at(path)
        out: list[tuple[str, int, int]] = []
        if fs.exists(java):
            every, root = fs.listFiles(java, True), fs.resolvePath(java).toUri().getPath()
            while every.hasNext():
                s = every.next()
                name = s.getPath().toUri().getPath().removeprefix(root).lstrip("/") or s.getPath().getName()
                if not any(part[0] in "._" for part in name.split("/")):
                    out.append((name, s.getLen(), s.getModificationTime()))
        return sorted(out)

    def read_json(self, path: str) -> dict | None:
        if not self.exists(path):
            return None
        return json.loads("\n".join(r.value for r in self.spark.read.text(path, wholetext=True).collect()))

    def write_json(self, path: str, content: dict) -> None:
        """Written beside, then moved there."""
        java, fs = self._at(f"{path}.{uuid.uuid4().hex}")
        stream = fs.create(java, True)
        stream.write(bytearray(json.dumps(content, sort_keys=True).encode()))
        stream.hsync()
        stream.close()
        self.replace(java.toString(), path)

    def replace(self, path: str, to: str) -> None:
        """What is at ``path`` takes the place of ``to``, which goes only once the new one stands."""
        old = f"{to.rsplit('/', 1)[0]}/.old-{uuid.uuid4().hex}"
        if self.exists(to):
            self.move(to, old)
        self.move(path, to)
        self.delete(old)

    def write(self, df: DataFrame, path: str) -> None:
        folder, name = path.rsplit("/", 1)
        part = f"{folder}/.part-{name}-{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").parquet(part)
        self.replace(part, path)

    # generations

    def warehouse(self, wiki: str) -> str:
        return f"{self.data}/warehouse/{wiki}"

    def publish(self, wiki: str, version: str) -> None:
        """Make a generation the one in use."""
        if not VERSION.match(version) or not self.exists(f"{self.warehouse(wiki)}/{version}"):
            raise ValueError(f"no generation {version} of {wiki}")
        self.write_json(f"{self.warehouse(wiki)}/active.json", {"version": version})

    def version(self, wiki: str) -> str | None:
        found = self.read_json(f"{self.warehouse(wiki)}/active.json")
        return found["version"] if found else None

    def active(self, wiki: str) -> str:
        """The generation in use; the folder itself where there is no pointer."""
        version = self.version(wiki)
        return f"{self.warehouse(wiki)}/{version}" if version else self.warehouse(wiki)

    def retire(self, wiki: str) -> list[str]:
        """Delete all generations but the one in use; without a pointer, none."""
        now = self.version(wiki)
        gone = [v for v in self.folders(self.warehouse(wiki)) if VERSION.match(v) and v != now] if now else []
        for v in gone:
            self.delete(f"{self.warehouse(wiki)}/{v}")
        return gone

    # receipts

    def inventory(self, path: str) -> list[list]:
        return [list(f) for f in self.files(path)]

    def receipt(self, wiki: str, stage: str) -> str:
        return f"{self.data}/stages/{wiki}/{self.version(wiki) or 'flat'}/{stage}.json"

    @staticmethod
    def digest(inputs: list, settings: dict) -> str:
        return hashlib.sha256(json.dumps([inputs, settings], sort_keys=True).encode()).hexdigest()

    def reusable(self, wiki: str, stage: str, inputs: list, settings: dict, outputs: dict[str, str]) -> bool:
        """Whether a stage's receipt is of these inputs and settings, and its outputs stand as they were written."""
        found = self.read_json(self.receipt(wiki, stage))
        return bool(found) and found["digest"] == self.digest(inputs, settings) and found["outputs"] == {k: self.inventory(p) for k, p in outputs.items()} and all(found["outputs"].values())

    def record(self, wiki: str, stage: str, inputs: list, settings: dict, outputs: dict[str, str], **more) -> None:
        self.write_json(self.receipt(wiki, stage), {"digest": self.digest(inputs, settings), "outputs": {k: self.inventory(p) for k, p in outputs.items()}, **more})
