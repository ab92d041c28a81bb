"""A document collection that can be changed (S6-S8, U1-U3): typed documents in Parquet files under a commit log.

Documents are VARIANT values, so a stored object comes back with its own fields and types whatever they are, and a path
into it is read typed (:func:`field`). ``path/data`` holds files that never change; ``path/log/<version>.json`` says which
files a version adds and takes away, and a version is there from the moment its log entry is put in place, which only one
writer can do. A writer that comes second reads what the first did: an append goes in behind it, a change is made anew
only if the first took away a file that it rewrites. Readers keep the version they began with.

Changes rewrite the files that hold a match and no other; finding those is a filter over one field that returns one
row per file. The driver sees file names, never documents.

Every document has a place in the order of insertion: the commit it came with, and its row in the files of that commit,
which are written in order. Rewritten files carry it along, so "the first match" is the same document however the files
are cut into tasks.
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import RECORD_FIELDS

# A log entry holds the whole list of files at every so many versions, so reading a version opens few entries.
FULL_EVERY = 32

_SCHEMA = "doc VARIANT, raw STRING, seq STRUCT<commit: INT, part: STRING, row: BIGINT>"


class Conflict(Exception):
    """Another writer has put the version in place."""


def parse_json(text: DataFrame, col: str = "text") -> DataFrame:
    """``doc`` from JSON text, parsed once; ``raw`` keeps what is no JSON object (bad text, another JSON value, NULL as
    an empty text), and its ``doc`` is NULL. Other columns stay."""
    others = [c for c in text.columns if c not in ("doc", "raw", col)]
    parsed = text.select(*others, F.col(col).alias("_text"), F.expr(f"try_parse_json(`{col}`)").alias("_doc"))
    good = "schema_of_variant(_doc) LIKE 'OBJECT<%'"
    return parsed.selectExpr(*[f"`{c}`" for c in others], f"IF({good}, _doc, NULL) AS doc",
                             f"IF({good}, NULL, COALESCE(_text, '')) AS raw")


def records(rows: DataFrame, col: str = "record") -> DataFrame:
    """``doc`` from positional seven-string records (date, open, high, low, close, volume, id)."""
    fields = ", ".join(f"'{name}', CAST(`{col}`[{i}] AS STRING)" for i, name in enumerate(RECORD_FIELDS))
    return rows.withColumn("doc", F.expr(f"to_variant_object(named_struct({fields}))"))


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(text, at) of the lines of text files; ``at`` orders them by file and line however the files are split."""
    at = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                  F.monotonically_increasing_id().alias("line"))
    return spark.read.text(path).select(F.col("value").alias("text"), at.alias("at"))


def _path_sql(by: str) -> str:
    return "$" + "".join(f"[\"{p}\"]" if not p.isidentifier() else f".{p}" for p in by.split("."))


def field(by: str, kind: str = "string", doc: str = "doc") -> Column:
    """The value at a path (``a`` or ``b.c``) of a document as ``kind``; NULL where there is none or it does not fit."""
    return F.expr(f"try_variant_get(`{doc}`, '{_path_sql(by)}', '{kind}')")


def matches(by: str, value) -> Column:
    """Whether a document's ``by`` equals ``value`` in type and value: text matches text only, numbers any number. NULL
    matches a field that is null or not there."""
    if value is None:
        return field(by).isNull()
    kind = F.expr(f"schema_of_variant(try_variant_get(doc, '{_path_sql(by)}', 'variant'))")
    if isinstance(value, bool):
        found = (kind == "BOOLEAN") & (field(by, "boolean") == F.lit(value))
    elif isinstance(value, (int, float)):
        found = ~kind.isin("STRING", "BOOLEAN") & (field(by, "double") == F.lit(float(value)))
    else:
        found = (kind == "STRING") & (field(by) == F.lit(value))
    return F.coalesce(found, F.lit(False))


def with_field(by: str, value) -> Column:
    """The document with its top-level field ``by`` set to ``value``, the others as they are."""
    if "." in by:
        raise ValueError("only a top-level field can be set")
    new = F.create_map(F.lit(by), F.parse_json(F.lit(json.dumps(value))))
    rest = F.map_filter(F.from_json(F.to_json("doc"), "MAP<STRING, VARIANT>"), lambda k, _: k != by)
    return F.parse_json(F.to_json(F.map_concat(rest, new)))


class DocumentStore:
    """A collection at ``path`` (any Hadoop file system; for several writers one whose rename is atomic)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        root = self._path(self.path)
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = root.getFileSystem(conf)
        self.root = self.fs.makeQualified(root).toString()
        self._context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(root.toUri(), conf) \
            if self.fs.getScheme() != "file" else None
        self.fs.mkdirs(self._path(f"{self.root}/log"))

    # ---- the log ------------------------------------------------------------------

    def version(self) -> int:
        """The latest version; 0 is the empty collection."""
        names = [s.getPath().getName() for s in self.fs.listStatus(self._path(f"{self.root}/log"))]
        return max([int(n[:-5]) for n in names if n.endswith(".json")], default=0)

    def _entry(self, version: int) -> dict:
        with_ = self.fs.open(self._path(f"{self.root}/log/{version:012d}.json"))
        try:
            return json.loads(bytes(with_.readAllBytes()).decode())
        finally:
            with_.close()

    def files(self, version: int | None = None) -> list[str]:
        """The data files of a version (the latest by default), relative to the data folder."""
        version = self.version() if version is None else version
        todo = []
        for v in range(version, 0, -1):
            todo.append(self._entry(v))
            if "files" in todo[-1]:
                break
        have = {}
        for e in reversed(todo):
            have = dict.fromkeys(e["files"]) if "files" in e else have
            if "files" not in e:
                have = {f: None for f in have if f not in set(e["remove"])} | dict.fromkeys(e["add"])
        return list(have)

    def _put(self, version: int, add: list[str], remove: list[str], what: str) -> None:
        """Put a log entry in place, or raise Conflict; never replaces one."""
        entry = {"what": what, "add": add, "remove": remove}
        if version % FULL_EVERY == 0:
            gone = set(remove)
            entry["files"] = [f for f in self.files(version - 1) if f not in gone] + add
        final, draft = f"{self.root}/log/{version:012d}.json", f"{self.root}/log/.{uuid.uuid4().hex}.tmp"
        out = self.fs.create(self._path(draft))
        out.write(json.dumps(entry).encode())
        out.close()
        try:
            if self._context is None:  # a local rename replaces, a link does not
                local = [self._path(p).toUri().getPath() for p in (draft, final)]
                os.link(*local)
            else:
                none = self.spark.sparkContext._gateway.new_array(
                    self.spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename, 0)
                self._context.rename(self._path(draft), self._path(final), none)
        except Exception as e:  # noqa: BLE001 - the file system's own error type says the same
            if self.fs.exists(self._path(final)):
                raise Conflict(version) from e
            raise
        finally:
            self.fs.delete(self._path(draft), False)

    def _commit(self, base: int, add: list[str], remove: list[str], what: str) -> int:
        """The next free version after ``base``; Conflict if a version since has taken away a file of ``remove``."""
        while True:
            for v in range(base + 1, self.version() + 1):
                if set(remove) & set(self._entry(v)["remove"]):
                    raise Conflict(v)
                base = v
            try:
                self._put(base + 1, add, remove, what)
                return base + 1
            except Conflict:
                continue

    # ---- reading ------------------------------------------------------------------

    def _scan(self, files: list[str]) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], "file STRING").select(
                F.expr("CAST(NULL AS VARIANT)").alias("doc"), F.lit(None).cast("string").alias("raw"),
                F.expr("CAST(NULL AS STRUCT<commit: INT, part: STRING, row: BIGINT>)").alias("seq"), "file")
        # The commit folder and the file name are the last two parts of the path.
        at = F.expr("named_struct('commit', CAST(regexp_extract(_metadata.file_path, '/c=(\\\\d+)[^/]*/[^/]*$', 1) AS INT),"
                    " 'part', _metadata.file_name, 'row', _metadata.row_index)")
        return (self.spark.read.schema(_SCHEMA).parquet(*[f"{self.root}/data/{f}" for f in files])
                .select("doc", "raw", F.coalesce("seq", at).alias("seq"),
                        F.concat_ws("/", F.expr("element_at(split(_metadata.file_path, '/'), -2)"),
                                    "_metadata.file_name").alias("file")))

    def read(self, version: int | None = None) -> DataFrame:
        """(doc, seq) of every document of a version; ``seq`` orders them by insertion."""
        return self._scan(self.files(version)).where("raw IS NULL").select("doc", "seq")

    def rejects(self, version: int | None = None) -> DataFrame:
        """(raw, seq) of the texts that were handed in and are no documents."""
        return self._scan(self.files(version)).where("raw IS NOT NULL").select("raw", "seq")

    # ---- writing ------------------------------------------------------------------

    def _write(self, rows: DataFrame, base: int) -> list[str]:
        folder = f"c={base + 1:012d}-{uuid.uuid4().hex[:12]}"
        rows.write.parquet(f"{self.root}/data/{folder}")
        names = [s.getPath().getName() for s in self.fs.listStatus(self._path(f"{self.root}/data/{folder}"))]
        return [f"{folder}/{n}" for n in sorted(names) if n.startswith("part-")]

    def insert(self, docs: DataFrame, order=None) -> int:
        """Append ``doc`` (and, where there is one, ``raw``) in the order of the columns ``order``, or as the
        partitions come without it. Returns the version."""
        base = self.version()
        if order is not None:
            keys = [order] if isinstance(order, (str, Column)) else list(order)
            n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            docs = docs.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
        raw = F.col("raw") if "raw" in docs.columns else F.lit(None).cast("string")
        return self._commit(base, self._write(docs.select("doc", raw.alias("raw")), base), [], "insert")

    def insert_json(self, text: DataFrame, col: str = "text", order=None) -> int:
        """Append the JSON objects among texts; the others are kept as rejects of the same version. Each text is
        parsed once and both are written in one pass."""
        return self.insert(parse_json(text, col), order)

    def _change(self, cond: Column, what: str, first: bool, change) -> int:
        """Rewrite the files that hold a match of ``cond``: ``change(rows, match)`` gives the new rows."""
        while True:
            base = self.version()
            rows = self._scan(self.files(base))
            hit = F.col("raw").isNull() & cond
            if first:
                at = rows.where(hit).agg(F.min(F.struct("seq", "file")).alias("at")).select("at.*").first()
                touched = [at["file"]] if at["file"] is not None else []
                hit = hit & (F.col("seq") == F.struct(*[F.lit(at["seq"][k]).cast(t).alias(k) for k, t in (
                    ("commit", "int"), ("part", "string"), ("row", "bigint"))])) if touched else hit
            else:
                touched = [r["file"] for r in rows.where(hit).select("file").distinct().collect()]
            if not touched:
                return base
            new = change(self._scan(touched), hit).select("doc", "raw", "seq")
            try:
                return self._commit(base, self._write(new, base), touched, what)
            except Conflict:
                continue  # a file that was to be rewritten is gone: look again

    def update(self, by: str, old, new, multi: bool = False) -> int:
        """Set the top-level field ``by`` to ``new`` where it equals ``old``: in the first such document in the order
        of insertion, or with ``multi`` in all. Returns the version (the same one if nothing matches)."""
        return self._change(matches(by, old), "update", not multi, lambda rows, hit: rows.withColumn(
            "doc", F.when(hit, with_field(by, new)).otherwise(F.col("doc"))))

    def remove_by(self, by: str, value) -> int:
        """Delete every document whose ``by`` equals ``value``. Returns the version."""
        return self._change(matches(by, value), "delete", False, lambda rows, hit: rows.where(~hit))

    def remove(self, value) -> int:
        """Delete every document with ``open`` equal to ``value``."""
        return self.remove_by("open", value)
