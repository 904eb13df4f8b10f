"""Archive sources: tar archives (plain or gzip-compressed, whatever the file name says) -> member files.

Archives are read with ``binaryFile`` (one archive per row) and expanded in Arrow batches of bounded size; members are never written to
disk, so member paths cannot escape a target folder. Packing (used to build archives from table data) groups members by
a caller-chosen archive id whose group size is bounded by construction.
"""

from __future__ import annotations

import fnmatch
import io
import posixpath
import re
import tarfile
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MEMBER_SCHEMA = "archive string, member string, content binary"
BATCH_BYTES = 8 << 20                                  # of member files in an output batch
LEVEL = 1                                              # of compression: archives made here are read by the next step, not kept
GZIP = 16 + zlib.MAX_WBITS


def _content(tar: tarfile.TarFile, member: tarfile.TarInfo) -> bytes:
    """A member's bytes, read where they stand: a file object for each costs as much as reading it."""
    if member.issparse():
        return tar.extractfile(member).read()
    tar.fileobj.seek(member.offset_data)
    content = tar.fileobj.read(member.size)
    if len(content) != member.size:
        raise tarfile.ReadError("unexpected end of data")
    return content


def _members(batches, glob: str, batch_bytes: int = BATCH_BYTES):
    """Batches of the archives' members, some ``batch_bytes`` each, however many archives come at once."""
    import pyarrow as pa
    archives, members, contents, size = [], [], [], 0
    wanted = re.compile(fnmatch.translate(glob)).match

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(archives, pa.string()), pa.array(members, pa.string()), pa.array(contents, pa.binary())],
                                          names=["archive", "member", "content"])

    for given in batches:
        for name, blob in zip(given.column(0), given.column(1)):
            name, blob = name.as_py(), blob.as_py()
            if blob is None:
                continue
            try:
                # mode "r:*" detects compression from the bytes (a ".tar.gz" name may hold a plain tar)
                with tarfile.open(fileobj=io.BytesIO(blob), mode="r:*") as tar:
                    for m in tar:
                        if not m.isfile() or not wanted(posixpath.basename(m.name)):
                            continue
                        content = _content(tar, m)
                        archives.append(name)
                        members.append(m.name)
                        contents.append(content)
                        size += len(content)
                        if size >= batch_bytes:
                            yield batch()
                            archives, members, contents, size = [], [], [], 0
            except tarfile.TarError:
                archives.append(name)
                members.append(None)
                contents.append(None)
    if archives:
        yield batch()


def expand_archives(archives: DataFrame, glob: str = "*") -> DataFrame:
    """(archive, content BINARY) -> (archive, member, content); an unreadable archive gives one row with NULL member."""
    return archives.select("archive", "content").mapInArrow(lambda it: _members(it, glob), MEMBER_SCHEMA)


def archive_members(spark: SparkSession, path: str, archive_glob: str = "*", member_glob: str = "*") -> DataFrame:
    raw = spark.read.format("binaryFile").load(f"{path.rstrip('/')}/{archive_glob}")
    return expand_archives(raw.select(F.col("_metadata.file_name").alias("archive"), "content"), member_glob)


def _pack(group):
    import pyarrow as pa
    archive, member, content = (group.column(c).to_pylist() for c in ("archive", "member", "content"))
    # Member by member into one compressor: a tar is a header and the padded bytes of every member, and two empty blocks.
    info, packed, gz = tarfile.TarInfo(), [], zlib.compressobj(LEVEL, zlib.DEFLATED, GZIP)
    for name, data in sorted(zip(member, content)):
        info.name, info.size = str(name), len(data)
        packed.append(gz.compress(b"".join((info.tobuf(tarfile.GNU_FORMAT), data, bytes(-len(data) % tarfile.BLOCKSIZE)))))
    packed += gz.compress(bytes(2 * tarfile.BLOCKSIZE)), gz.flush()
    return pa.table({"archive": pa.array([str(archive[0])], pa.string()), "content": pa.array([b"".join(packed)], pa.binary())})


def pack_archives(members: DataFrame, archive_col: str, member_col: str, content_col: str) -> DataFrame:
    """(archive, content BINARY) with one gzip tar per archive id. The caller bounds the members per archive id."""
    df = members.select(F.col(archive_col).cast("string").alias("archive"), F.col(member_col).alias("member"),
                        F.col(content_col).cast("binary").alias("content"))
    return df.groupBy("archive").applyInArrow(_pack, "archive string, content binary")
