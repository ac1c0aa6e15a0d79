"""A named chunk store on any Hadoop-compatible filesystem (A15 and persistence of A7-A14).

Layout: ``<root>/snapshots/commit=<c>/bucket=<b>/`` holds Parquet files, written
once and never changed; ``bucket`` is a hash of the article id.
``<root>/versions/<n>`` is the manifest of version ``n``: the schema, the number
of buckets, and the files that are live.  The highest number is the live
version; a folder that has snapshots but no version is an error, never taken for
a new store.

A write puts its files down first and then claims version ``n + 1`` by renaming a
finished manifest to that name, which fails if another writer was there first
(the filesystem's rename must not replace a file, as on HDFS).  The loser starts
anew from the winner's version, so two writers never both win and no update is
lost.  Its own files stay unused.

Append, upsert and delete touch only the files that hold their articles: the
buckets of the articles narrow the files down, and only files with a match are
written anew.  All other files pass into the next version by name.  Lookups read
the files of the buckets asked for; a small request is pushed down to Parquet,
whose Bloom filters on ``id`` and ``article_id`` skip row groups.  Readers that
began on an older version keep its files until ``vacuum()`` is called.

The chunks of an article that :meth:`ChunkStore.append_articles` adds are one row of
a file (:func:`~folio.operators.chunking.packed_records`): every record's document
begins with the article's title, which may be as long as the text, so records would
hold, sort and move it once a chunk.  Such rows become records when they are read,
and are changed as they are.  Records that are handed in as such stay rows.
"""

from __future__ import annotations

import json
import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.operators import store as S
from folio.operators.chunking import STORE_MAX_TOKENS, chunk_id, packed_records, store_records, unpacked

# --- fixed values -----------------------------------------------------------
ATTEMPTS = 20          # writers that were first so many times in a row make a write fail
LOOKUP_IDS = 1000      # requests up to this size go into the plan as a filter
CROWDED = 32           # files of a bucket from which compact() rewrites it
KEY_BYTES = 1 << 23    # keys that a rewrite takes to the files at once
PARTS = T.StructField("_parts", T.ArrayType(T.StructType([T.StructField("i", T.IntegerType()), T.StructField("text", T.StringType())])))
PACKED = {"id", "article_id", "chunk_index", "title", "document"}   # columns without which rows cannot be packed
# ---------------------------------------------------------------------------


class LostRace(RuntimeError):
    """Other writers claimed every version that this write tried to claim."""


class ChunkStore:
    """Handle on a store folder; reads return DataFrames, writes counts."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType | None = None, buckets: int = S.STORE_BUCKETS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schema = schema
        self.buckets = buckets
        path = spark._jvm.org.apache.hadoop.fs.Path(self.root)
        self._fs = path.getFileSystem(spark._jsc.hadoopConfiguration())

    # -- versions -------------------------------------------------------------
    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _names(self, folder: str) -> list[str]:
        if not self._fs.exists(self._path(folder)):
            return []
        return [s.getPath().getName() for s in self._fs.listStatus(self._path(folder))]

    def current_snapshot(self) -> int | None:
        """Number of the live version; None for a new store."""
        numbers = [int(n) for n in self._names("versions") if n.isdigit()]
        if numbers:
            return max(numbers)
        if any(not n.startswith((".", "_")) for n in self._names("snapshots")):
            raise ValueError(f"{self.root} holds snapshots but no version file")
        return None

    def _manifest(self) -> tuple[int | None, dict]:
        n = self.current_snapshot()
        if n is None:
            return None, {"schema": self.schema and self.schema.jsonValue(), "buckets": self.buckets, "files": []}
        about = json.loads(self.spark.read.text(f"{self.root}/versions/{n}", wholetext=True).first()[0])
        self.buckets = about["buckets"]
        if about["schema"]:
            self.schema = T.StructType.fromJson(about["schema"])
        return n, about

    def _claim(self, n: int, manifest: dict) -> bool:
        """Make ``manifest`` version ``n``; False if there is one already."""
        mine = f"versions/.{uuid.uuid4().hex}"
        self._fs.mkdirs(self._path("versions"))
        out = self._fs.create(self._path(mine), False)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        try:
            won = not self._fs.exists(self._path(f"versions/{n}")) and self._fs.rename(self._path(mine), self._path(f"versions/{n}"))
        except Py4JJavaError as e:
            if "FileAlreadyExists" not in str(e.java_exception):
                raise
            won = False
        if not won:
            self._fs.delete(self._path(mine), False)
        return won

    def _commit(self, change) -> object:
        """Claim the next version with ``change(manifest) -> (files, result)``; begun anew whenever another writer was first."""
        for _ in range(ATTEMPTS):
            n, about = self._manifest()
            if n is None:  # first, so that data never lie in a store without a version
                self._claim(0, about)
                continue
            files, result = change(about)
            if files == about["files"]:
                return result
            if self._claim(n + 1, {"schema": self.schema and self.schema.jsonValue(), "buckets": self.buckets, "files": files}):
                return result
        raise LostRace(f"{ATTEMPTS} versions of {self.root} were claimed by others")

    # -- reads ----------------------------------------------------------------
    def _bucket(self, article_id: Column) -> Column:
        return S.bucket_of(article_id, self.buckets)

    def _in_buckets(self, files: list[str], buckets) -> list[str]:
        wanted = {f"/bucket={b}/" for b in buckets}
        return [f for f in files if re.search(r"/bucket=\d+/", f)[0] in wanted]

    def _read(self, files: list[str]) -> DataFrame:
        """The rows of the files: records, or an article's records in one row."""
        if self.schema is None:
            raise ValueError("empty store without a schema")
        schema = T.StructType([*self.schema.fields, PARTS, T.StructField("bucket", T.IntegerType())])
        if not files:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", f"{self.root}/snapshots")
        return reader.parquet(*[f"{self.root}/{f}" for f in files])

    def _records(self, rows: DataFrame) -> DataFrame:
        """One row per record."""
        return unpacked(rows) if PACKED <= set(self.schema.names) else rows.drop(PARTS.name)

    @staticmethod
    def _in_row() -> Column:
        """How many records a row holds."""
        return F.when(F.col(PARTS.name).isNull(), 1).otherwise(F.size(PARTS.name))

    def is_open(self) -> bool:
        """True if the store has been written to."""
        return self.current_snapshot() is not None

    def df(self) -> DataFrame:
        """The live records (an empty frame with the schema when none were written)."""
        return self._records(self._read(self._manifest()[1]["files"])).select(*self.schema.names, "bucket")

    def files(self) -> list[str]:
        """The live files, relative to the store's folder."""
        return self._manifest()[1]["files"]

    def _touched(self, files: list[str], article_ids: DataFrame) -> list[str]:
        """Files of the buckets of the given article ids; the distinct buckets are a few numbers at most."""
        found = article_ids.select(self._bucket(F.col("article_id")).alias("b")).distinct().collect()
        return self._in_buckets(files, [r["b"] for r in found if r["b"] is not None])

    def _looked_up(self, ids: DataFrame) -> DataFrame:
        """The rows that a request can concern: of its buckets, and of its ids if they are few."""
        files = self._manifest()[1]["files"]
        few = ids.select("id", S.article_of(F.col("id")).alias("a"), self._bucket(S.article_of(F.col("id"))).alias("b")).distinct().limit(LOOKUP_IDS + 1).collect()
        if len(few) <= LOOKUP_IDS:
            known = [r for r in few if r["id"] is not None]
            buckets = sorted({r["b"] for r in known})
            rows = self._read(self._in_buckets(files, buckets)).where(F.col("bucket").isin(buckets))
            return rows.where(F.col("id").isin([r["id"] for r in known]) | F.col("article_id").isin(sorted({r["a"] for r in known})))
        return self._read(self._touched(files, ids.select(S.article_of(F.col("id")).alias("article_id"))))

    def _chosen(self, rows: DataFrame, asked: DataFrame, keep: bool) -> DataFrame:
        """The rows' records that are among ``asked`` (see ``store.by_article``), or without ``keep`` all others."""
        listed = F.col("_ids").isNotNull()
        whole = F.col(PARTS.name).isNull()
        found = F.coalesce(F.array_contains("_ids", F.col("id")), F.lit(False))
        parts = F.filter(PARTS.name, lambda p: F.coalesce(F.array_contains("_numbers", p["i"]), F.lit(False)) == F.lit(keep))
        # a row that is a record goes by its own id, as a request does
        both = rows.withColumn("_asked", F.coalesce(S.article_of(F.col("id")), F.col("article_id")))
        both = both.join(asked.withColumnRenamed("article_id", "_asked"), "_asked", "inner" if keep else "left")
        both = both.withColumn(PARTS.name, F.when(listed, parts).otherwise(F.col(PARTS.name)))
        return both.where(F.when(whole, found == F.lit(keep)).otherwise(F.size(PARTS.name) > 0)).select(*rows.columns)

    def get(self, ids: DataFrame) -> DataFrame:
        """The records with these ids (column ``id``).

        Ids are looked up before any text is read, so a request that is mostly unknown,
        or asks for few records, does not shuffle the texts of all others.
        """
        rows = self._looked_up(ids)
        found = S.get(self._records(rows).select("id"), ids).distinct()
        size = found.agg(F.sum(F.octet_length("id") + 64)).first()[0] or 0
        asked = S.by_article(found)
        return self._records(self._chosen(rows, F.broadcast(asked) if size <= KEY_BYTES else asked, True)).select(*self.schema.names, "bucket")

    def exists(self, ids: DataFrame) -> DataFrame:
        """A10: each requested id with a stored / not stored flag."""
        return S.exists(ids, self._records(self._looked_up(ids)))

    def list(self, limit: int | None = None, columns: list[str] | None = None) -> DataFrame:
        """All records ordered by id; with ``columns``, these only, and texts are not moved if the document is not among them.

        Rows are ordered by their least id and become records after that, in order, as
        the ids of an article lie together.  Other ids come between them only if they have
        the same root, the part before the first ``_chunk_``; packed rows that share their
        root are unpacked before.
        """
        rows = self._read(self._manifest()[1]["files"])
        wanted = columns or [*self.schema.names, "bucket"]
        if limit is not None or not PACKED <= set(self.schema.names):
            return S.list_records(self.df(), limit).select(*wanted)
        if "document" not in wanted:
            bare = F.transform(PARTS.name, lambda p: F.struct(p["i"].alias("i"), F.lit(None).cast("string").alias("text")))
            rows = rows.withColumn(PARTS.name, bare)
        packed = F.col(PARTS.name).isNotNull()
        rooted = rows.withColumn("_root", F.substring_index(F.coalesce("id", "article_id"), "_chunk_", 1))
        shared = rooted.where("_root is not null").groupBy("_root").agg(F.count(F.lit(1)).alias("n"), F.max(packed).alias("p")).where("n > 1 and p").select("_root")
        if not shared.isEmpty():
            apart = rooted.join(shared.withColumn("_shared", F.lit(True)), "_root", "left")
            split = F.when(packed & F.col("_shared"), F.transform(PARTS.name, lambda p: F.array(p))).otherwise(F.array(PARTS.name))
            rows = apart.select(*[c for c in rows.columns if c != PARTS.name], F.explode(split).alias(PARTS.name))
        first = F.when(packed, chunk_id(F.col("article_id"), F.col(PARTS.name)[0]["i"])).otherwise(F.col("id"))
        # their number is given: it follows the records that the rows become, not the size of the rows
        ordered = rows.withColumn("_first", first).repartitionByRange(self._tasks(), "_first").sortWithinPartitions("_first")
        return self._records(ordered).select(*wanted)

    def _tasks(self) -> int:
        """Tasks of work on articles that their size does not show: chunking, or records that repeat a title."""
        return max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), 2 * self.spark.sparkContext.defaultParallelism)

    def count(self) -> DataFrame:
        """Number of records and of articles."""
        return S.count(self._read(self._manifest()[1]["files"]), self._in_row())

    # -- writes ---------------------------------------------------------------
    def _write(self, rows: DataFrame, spread: bool = True) -> tuple[list[str], dict]:
        """Put rows down as files of a new commit; their names, and the counts observed by the write itself.

        Without ``spread`` rows stay in their tasks, for rows that lie by bucket already.
        """
        folder = f"snapshots/commit={uuid.uuid4().hex}"
        seen = Observation()
        if spread or "bucket" not in rows.columns:
            rows = rows.withColumn("bucket", self._bucket(F.col("article_id")))
        parts = F.col(PARTS.name) if PARTS.name in rows.columns else F.lit(None).cast(PARTS.dataType)
        out = rows.select(*self.schema.names, parts.alias(PARTS.name), "bucket")
        first = F.when(F.col(PARTS.name).isNull(), F.col("chunk_index") == 0).otherwise(F.exists(PARTS.name, lambda p: p["i"] == 0))
        out = out.observe(seen, F.coalesce(F.sum(self._in_row()), F.lit(0)).alias("records"), F.count_if(first).alias("articles"))
        # adaptive execution joins small buckets in one task and splits large ones, so the number
        # of tasks and files follows the size of the rows
        writer = (out.hint("rebalance", F.col("bucket")) if spread else out).write.option("compression", "zstd")
        # a filter as large as the file's ids need, not of the fixed largest size
        writer = writer.option("parquet.bloom.filter.enabled#id", "true").option("parquet.bloom.filter.enabled#article_id", "true")
        writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
        writer.partitionBy("bucket").parquet(f"{self.root}/{folder}")
        written = self.spark.read.schema(self.schema).parquet(f"{self.root}/{folder}").inputFiles()
        if not written:  # an empty plan may be cut down to nothing, its observation with it
            return [], {"records": 0, "articles": 0}
        return sorted(self._relative(f) for f in written), seen.get

    def _rewrite(self, old: list[str], keys: DataFrame, change) -> list[str]:
        """New files of ``change(rows, keys)`` for the rows of ``old``; ``keys`` has ``article_id`` or ``id`` and what ``change`` needs.

        Both meet bucket by bucket, several small buckets together, as many keys at a time as
        may be broadcast: the rows, which hold the texts, are not shuffled.  Only the keys of a
        bucket that has more than that meet its rows by Spark's own choice of a join.
        """
        article = F.col("article_id") if "article_id" in keys.columns else S.article_of(F.col("id"))
        keys = keys.withColumn("_bucket", self._bucket(article)).persist()
        try:
            size = F.sum(F.octet_length(F.to_json(F.struct("*"))) + 64).alias("size")
            sizes = {r["_bucket"]: r["size"] for r in keys.groupBy("_bucket").agg(size).collect()}   # a few numbers
            todo = sorted({int(re.search(r"/bucket=(\d+)/", f)[1]) for f in old})
            files: list[str] = []
            while todo:
                some, held = [], 0
                while todo and (not some or held + sizes.get(todo[0], 0) <= KEY_BYTES):
                    held += sizes.get(todo[0], 0)
                    some.append(todo.pop(0))
                part = keys.where(F.col("_bucket").isin(some)).drop("_bucket")
                few = held <= KEY_BYTES
                files += self._write(change(self._read(self._in_buckets(old, some)), F.broadcast(part) if few else part), spread=not few)[0]
            return files
        finally:
            keys.unpersist()

    @staticmethod
    def _relative(path: str) -> str:
        return path[path.rindex("/snapshots/") + 1:]

    def _holding(self, files: list[str], keys: DataFrame, by: str) -> list[str]:
        """Of ``files``, those with a row whose ``by`` is among the keys."""
        if not files:
            return []
        rows = self._read(files).withColumn("_file", F.col("_metadata.file_path"))
        rows = (self._records(rows) if by == "id" else rows).select(by, "_file")
        found = rows.join(keys.select(by), by, "left_semi").select("_file").distinct().collect()   # at most the number of files
        return sorted(self._relative(r["_file"]) for r in found)

    def append(self, records: DataFrame) -> int:
        """Add the records of articles that are not stored; returns how many records were written.

        Callers hand in one version of an article (see ``pages.one_per_id``).
        """
        return self._append(records)["records"]

    def _append(self, records: DataFrame) -> dict:
        def change(about: dict):
            if self.schema is None:
                self.schema = records.schema
            if not about["files"]:
                files, seen = self._write(records)
                return files, seen | {"known": 0}
            # the articles are kept, not their texts
            articles = records.groupBy("article_id").agg(F.count_if(F.col("chunk_index") == 0).alias("n")).persist()
            try:
                stored = self._read(self._touched(about["files"], articles))
                files, seen = self._write(S.insert_new(stored, records))
                handed = articles.agg(F.sum("n")).first()[0] or 0
            finally:
                articles.unpersist()
            return about["files"] + files, seen | {"known": handed - seen["articles"]}
        return self._commit(change)

    def append_articles(self, articles: DataFrame, max_tokens: int = STORE_MAX_TOKENS, columns: list[str] | None = None) -> int:
        """A7 with D1 + D4: chunk the articles that are not stored and add their records; returns how many.

        Callers hand in one version of an article, as for :meth:`append`.  Articles
        go to their buckets before they are chunked: records repeat the title, and
        with ``columns`` None hold all columns of the article but its whole text,
        of which a record's document is a part.
        """
        return self._append_articles(articles, max_tokens, columns)["records"]

    def _append_articles(self, articles: DataFrame, max_tokens: int, columns: list[str] | None) -> dict:
        def change(about: dict):
            new, known = articles, 0
            if about["files"]:
                ids = articles.select(F.col("id").alias("article_id"))
                stored = self._read(self._touched(about["files"], ids)).select("article_id").distinct()
                known = ids.join(stored, "article_id", "left_semi").count()
                new = S.insert_new(stored, articles.withColumn("article_id", F.col("id"))).drop("article_id")
            if self.schema is None:
                made = store_records(articles, max_tokens=max_tokens).columns
                self.schema = store_records(articles, max_tokens=max_tokens).select(*(columns or [c for c in made if c not in ("content", "bucket")])).schema
            pack = packed_records if PACKED <= set(self.schema.names) else store_records
            files, seen = self._write(pack(self._dealt(new), max_tokens=max_tokens), spread=False)
            return about["files"] + files, seen | {"known": known}
        return self._commit(change)

    def _dealt(self, articles: DataFrame) -> DataFrame:
        """The articles by bucket, a large bucket in several tasks: chunking is the work, so the tasks follow the cores too."""
        tasks = self._tasks()
        shares = -(-4 * tasks // self.buckets)
        out = articles.withColumn("bucket", self._bucket(F.col("id")))
        return out.repartition(tasks, "bucket", F.pmod(F.xxhash64(F.lit("share"), F.col("id")), F.lit(shares)))

    def upsert(self, records: DataFrame, least: str | None = None) -> int:
        """Put the records in place of their articles' stored ones; returns how many were written.

        With ``least``, an article is replaced only by a version with a lesser value
        of that column (one value an article), so batches may come in any order and
        more than once, and the store ends with the least version of each.
        """
        def change(about: dict):
            if self.schema is None:
                self.schema = records.schema
            batch = records.persist()
            try:
                touched = self._touched(about["files"], batch)
                winners = batch
                if least and touched:
                    stored = self._read(touched).groupBy("article_id").agg(F.min(least).alias("_stored"))
                    beaten = batch.join(stored, "article_id").where(F.col("_stored") <= F.col(least)).select("article_id").distinct()
                    winners = batch.join(beaten, "article_id", "left_anti").select(*batch.columns).persist()
                articles = winners.select("article_id").distinct()
                old = self._holding(touched, articles, "article_id")
                added = winners.count()
                files = self._write(winners)[0] if added else []
                files += self._rewrite(old, articles, lambda rows, keys: S.delete(rows, keys, by="article_id")) if old else []
                if winners is not batch:
                    winners.unpersist()
            finally:
                batch.unpersist()
            return [f for f in about["files"] if f not in set(old)] + files, added
        return self._commit(change)

    def annotate(self, values: DataFrame) -> int:
        """Set columns of stored records from ``values``, one row per ``article_id``; returns how many articles were found.

        Articles that are not stored are passed over.  Only files that hold one of the articles are written anew.
        """
        names = [c for c in values.columns if c != "article_id"]

        def change(about: dict):
            given = values.persist()
            try:
                touched = self._touched(about["files"], given) if about["files"] else []
                old = self._holding(touched, given, "article_id")
                if not old:
                    return about["files"], 0
                put = [F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c in names else F.col(c) for c in self.schema.names]
                new = given.select("article_id", F.struct(*names).alias("_new"))
                kept = [F.col(c) for c in (PARTS.name, "bucket")]

                def annotated(rows: DataFrame, keys: DataFrame) -> DataFrame:
                    if PACKED & set(names):   # what a packed row has no value of, or makes documents of
                        rows = self._records(rows).withColumn(PARTS.name, F.lit(None).cast(PARTS.dataType))
                    return rows.join(keys, "article_id", "left").select(*put, *kept)

                files = self._rewrite(old, new, annotated)
                found = self._read(old).join(given, "article_id", "left_semi").select("article_id").distinct().count()
            finally:
                given.unpersist()
            return [f for f in about["files"] if f not in set(old)] + files, found
        return self._commit(change) if self.is_open() else 0

    def delete(self, ids: DataFrame, by: str = "id") -> None:
        """The next version without the ids; only files that hold one of them are written anew."""
        def change(about: dict):
            if not about["files"]:
                return about["files"], None
            keys = ids.select(by).distinct()
            article = F.col("article_id") if by == "article_id" else S.article_of(F.col("id"))
            old = self._holding(self._touched(about["files"], keys.select(article.alias("article_id"))), keys, by)
            if by == "id":
                keys = S.by_article(keys)
                files = self._rewrite(old, keys, lambda rows, some: self._chosen(rows, some, False)) if old else []
            else:
                files = self._rewrite(old, keys, lambda rows, some: S.delete(rows, some, by=by)) if old else []
            return [f for f in about["files"] if f not in set(old)] + files, None
        if self.is_open():
            self._commit(change)

    def reset(self) -> None:
        """A version without files and with the same schema."""
        self._commit(lambda about: ([], None))

    def compact(self, crowded: int = CROWDED) -> int:
        """Write buckets of at least ``crowded`` files anew, as many small appends leave them; returns how many."""
        def change(about: dict):
            sizes: dict[str, int] = {}
            for f in about["files"]:
                b = re.search(r"/bucket=(\d+)/", f)[1]
                sizes[b] = sizes.get(b, 0) + 1
            full = [b for b, n in sizes.items() if n >= crowded]
            if not full:
                return about["files"], 0
            old = self._in_buckets(about["files"], full)
            files, _ = self._write(self._read(old))
            return [f for f in about["files"] if f not in set(old)] + files, len(full)
        return self._commit(change)

    def vacuum(self) -> int:
        """Remove the files that only earlier versions name; returns how many were named.

        For a store that no reader has open on an earlier version.  Files of a write
        that has not claimed its version yet are named nowhere, and stay.
        """
        n, about = self._manifest()
        if n is None:
            return 0
        texts = self.spark.read.text([f"{self.root}/versions/{i}" for i in map(int, filter(str.isdigit, self._names("versions"))) if i < n], wholetext=True) if n else None
        old = {f for r in (texts.collect() if texts else []) for f in json.loads(r[0])["files"]} - set(about["files"])
        for f in sorted(old):
            self._fs.delete(self._path(f), False)
        return len(old)

    # -- articles -------------------------------------------------------------
    def store_articles(self, articles: DataFrame, max_tokens: int = STORE_MAX_TOKENS, columns: list[str] | None = None) -> DataFrame:
        """A7 + A8: chunk and append articles; one row ``(success, failed)``, zeros for an empty batch.

        Articles without a title or content go to a side table
        (:meth:`failed_articles`).  Both counts are observed by the writes
        themselves; an article that is stored already counts as a success.
        """
        seen = Observation()
        bad = articles.where(~S.storable()).observe(seen, F.count(F.lit(1)).alias("failed"))
        folder = f"{self.root}/failed/commit={uuid.uuid4().hex}"
        bad.write.parquet(folder)
        failed = 0 if self.spark.read.schema(articles.schema).parquet(folder).isEmpty() else seen.get["failed"]
        done = self._append_articles(articles.where(S.storable()), max_tokens, columns)
        return self.spark.createDataFrame([(done["articles"] + done["known"], failed)], "success bigint, failed bigint")

    def failed_articles(self) -> DataFrame | None:
        """The articles that :meth:`store_articles` could not store; None if it never ran."""
        return self.spark.read.parquet(f"{self.root}/failed").drop("commit") if self._names("failed") else None


def open_store(spark: SparkSession, root: str, schema: T.StructType | None = None, buckets: int = S.STORE_BUCKETS) -> ChunkStore:
    """Open the named store, or a new empty one when the folder has none (``buckets`` is fixed by its first version)."""
    return ChunkStore(spark, root, schema, buckets)
