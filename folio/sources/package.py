"""A package of files as a Spark data source to write to.

`rows.write.format("package").option("path", root).mode("append").save()` with rows(path, content): tasks write their files into a staging folder of the run
under root, each under a name of its own attempt first, and rename it when it is whole. The commit renames the staging folder to a version (`v-<n>`) and
then replaces `_CURRENT`, which names the version, its number of files and a digest of paths and contents: readers that go by it (`current`) see the old
package or the new one, whole. A run whose digest is the current one leaves everything as it is (`write_package` works the digest out first). An abort removes the staging folder; what tasks still
write then, and what a killed run leaves, `sweep` removes; the old package stays. The driver gets a count and a sum from each task, no list of files.

Files that the new rows do not have are gone from the new version, except those whose names match the option `protected` (a pattern), which are
carried along: what people have put there. The version before the new one is kept, older ones are removed.

Edge cases: a null content is an empty file; a null path, one that is absolute or leads out of the package is an error, and the run is aborted; of rows
that share a path one counts, so `write_package` refuses them before anything is written; no rows make an empty package. root is a folder or URI that
all executors can write to. Rows must be the same if a task runs again.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

CURRENT = "_CURRENT"
#: Files that a task reads. Spark's reader reckons a file as 4 MB at least and would make a task of each 32 small ones.
READ_AT_ONCE = 2_048


@dataclass
class Written(WriterCommitMessage):
    files: int
    digest: int


def _place(root: str) -> tuple[fs.FileSystem, str]:
    system, path = fs.FileSystem.from_uri(root)
    return system, path.rstrip("/")


def _current(system: fs.FileSystem, base: str) -> dict:
    if system.get_file_info(f"{base}/{CURRENT}").type != fs.FileType.File:
        return {"version": 0, "files": 0, "digest": ""}
    with system.open_input_stream(f"{base}/{CURRENT}") as f:
        return json.loads(f.read())


class PackageWriter(DataSourceWriter):
    def __init__(self, options: dict[str, str]) -> None:
        self.root, self.protected, self.run = options["path"], options.get("protected", ""), uuid.uuid4().hex

    def write(self, iterator: Iterator) -> Written:
        system, base = _place(self.root)
        staging, attempt = f"{base}/.staging-{self.run}", TaskContext.get().taskAttemptId()
        files = digest = 0
        made: set[str] = set()
        for row in iterator:
            path, content = row["path"], row["content"]
            if not path or path.startswith(("/", ".")) or any(part in ("", ".", "..") for part in path.split("/")):
                raise ValueError(f"no place within a package: {path!r}")
            content = content.encode() if isinstance(content, str) else bytes(content or b"")
            folder = f"{staging}/{path}".rsplit("/", 1)[0]
            if folder not in made:
                system.create_dir(folder, recursive=True)
                made.add(folder)
            with system.open_output_stream(f"{staging}/{path}.{attempt}.part") as out:
                out.write(content)
            system.move(f"{staging}/{path}.{attempt}.part", f"{staging}/{path}")
            files, digest = files + 1, digest + int.from_bytes(hashlib.sha256(path.encode() + b"\0" + hashlib.sha256(content).digest()).digest()[:16])
        return Written(files, digest % (1 << 128))

    def commit(self, messages: list[Written | None]) -> None:
        system, base = _place(self.root)
        staging, now = f"{base}/.staging-{self.run}", _current(system, base)
        files, digest = (sum(getattr(m, a) for m in messages if m) for a in ("files", "digest"))
        digest = f"{digest % (1 << 128):032x}"
        if now["version"] and (now["files"], now["digest"]) == (files, digest):
            self.abort(messages)
            return
        system.create_dir(staging, recursive=True)
        if self.protected and now["version"]:
            before = f"{base}/v-{now['version']}"
            for info in system.get_file_info(fs.FileSelector(before, recursive=True)):
                name = info.path.removeprefix(f"{before}/")
                if info.type == fs.FileType.File and re.search(self.protected, name) and system.get_file_info(f"{staging}/{name}").type == fs.FileType.NotFound:
                    system.create_dir(f"{staging}/{name}".rsplit("/", 1)[0], recursive=True)
                    system.copy_file(info.path, f"{staging}/{name}")
        version = now["version"] + 1
        # a version that a killed run renamed but did not name is none
        if system.get_file_info(f"{base}/v-{version}").type != fs.FileType.NotFound:
            system.delete_dir(f"{base}/v-{version}")
        system.move(staging, f"{base}/v-{version}")
        with system.open_output_stream(f"{base}/{CURRENT}.{self.run}") as out:
            out.write(json.dumps({"version": version, "files": files, "digest": digest}).encode())
        system.move(f"{base}/{CURRENT}.{self.run}", f"{base}/{CURRENT}")
        for info in system.get_file_info(fs.FileSelector(base)):
            old = re.fullmatch(r"v-([0-9]+)", info.base_name)
            if old and int(old[1]) < version - 1:
                system.delete_dir(info.path)

    def abort(self, messages: list[Written | None]) -> None:
        system, base = _place(self.root)
        if system.get_file_info(f"{base}/.staging-{self.run}").type != fs.FileType.NotFound:
            system.delete_dir(f"{base}/.staging-{self.run}")


class PackageSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "package"

    def writer(self, schema, overwrite: bool) -> PackageWriter:
        return PackageWriter(self.options)


def write_package(rows: DataFrame, root: str, protected: str = "") -> None:
    """Writes rows(path, content) as a package; paths that several rows share are refused first, and rows that the package has already, all of them and no
    others, are not written to a staging folder again. rows are read twice, so what is dear to work out should be kept before."""
    now = _current(*_place(root))
    content = F.sha2(F.coalesce(F.col("content").cast("binary"), F.lit(b"")), 256)
    row = F.sha2(F.concat(F.col("path").cast("binary"), F.lit(b"\0"), F.unhex(content)), 256)
    # a row's digest in four parts of 32 bits, whose sums a long holds
    parts = [F.conv(F.substring("row", 1 + 8 * i, 8), 16, 10).cast("long").alias(f"d{i}") for i in range(4 if now["version"] else 0)]
    paths = rows.select("path", row.alias("row")).select("path", *parts).groupBy("path").agg(F.count(F.lit(1)).alias("n"), *[F.sum(f"d{i}").alias(f"d{i}") for i in range(len(parts))])
    most, files, *sums = paths.agg(F.max("n"), F.sum("n"), *[F.sum(f"d{i}") for i in range(len(parts))]).first()
    if (most or 0) > 1:
        raise ValueError("several rows have one path")
    digest = sum((d or 0) << (32 * (3 - i)) for i, d in enumerate(sums)) % (1 << 128)
    if now["version"] and (now["files"], now["digest"]) == (files or 0, f"{digest:032x}"):
        return
    rows.sparkSession.dataSource.register(PackageSink)
    rows.select("path", "content").write.format("package").option("path", root).option("protected", protected).mode("append").save()


def current(root: str) -> str | None:
    """The folder of the package as it is now; none before the first commit."""
    system, base = _place(root)
    version = _current(system, base)["version"]
    return f"{root.rstrip('/')}/v-{version}" if version else None


def read_package(spark: SparkSession, root: str) -> DataFrame:
    """(path, content) of the package as it is now, but for empty files, which Spark's reader leaves out."""
    folder = current(root)
    if folder is None:
        return spark.createDataFrame([], "path string, content binary")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    tasks = max(spark.sparkContext.defaultParallelism, -(-_current(*_place(root))["files"] // READ_AT_ONCE))
    return files.select(F.regexp_extract("path", r"/v-[0-9]+/(.*)$", 1).alias("path"), "content").coalesce(tasks)


def sweep(root: str) -> int:
    """Removes what killed runs left; only while no run writes. How many there were."""
    system, base = _place(root)
    if system.get_file_info(base).type == fs.FileType.NotFound:
        return 0
    left = [i.path for i in system.get_file_info(fs.FileSelector(base)) if i.base_name.startswith(".staging-")]
    for path in left:
        system.delete_dir(path)
    return len(left)
