"""Index tables in shared storage: append-only, one partition per batch.

Layout below the root::

    documents/batch=N             forward index, one row per page
    postings/batch=N/word_bucket=B   sorted by word, block, url
    bounds/batch=N/word_bucket=B     what a block of pages holds of a word
    frequent                      words that most pages of the first batch hold
    pairs/batch=N/word_bucket=B   postings of neighbouring frequent words
    blocks/batch=N                lengths of the pages of a block
    keywords/batch=N/word_bucket=B   change of document frequency per word
    links/batch=N/child_bucket=B     edges by target
    superseded/batch=N            pages of earlier batches that batch N replaces
    batches/batch=N               written last: the batch counts from here on
    settings                      number of buckets, written once

The store numbers its batches itself, in the order they are committed. What a
writer calls a batch is a source and an epoch of that source; both are kept with
it, so the same one is never indexed twice and different writers never meet. One
writer at a time may append. Pages of a batch are numbered in blocks of similar length,
which share an upper bound of each word's weight and a bit per page
(``functions.blocks``). A batch only writes its own partitions, and the
next one overwrites what a failed attempt left. Readers drop superseded
pages. ``compact`` merges batches of similar size into a new one, whose ``batches`` row
names those it stands for; readers leave these out from then on. ``Index`` objects read from a store see the batches committed so far.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.functions.blocks import block_bounds, block_sizes, dead_pages, in_blocks
from trawl.functions.expr import bucket
from trawl.plans.index import Index, links_of, pair_postings, postings_of
from trawl.session import remove_folder

# The names of the columns that index tables share with their users.
DOCUMENTS = (
    "url string, title string, document_size int, modified timestamp_ntz, "
    "fetched timestamp, max_tf int, document_chars bigint, "
    "terms array<struct<word: string, term_frequency: int, in_title: boolean, "
    "positions: array<int>>>, children array<string>, block bigint, slot int, batch bigint"
)
POSTINGS = (
    "word string, url string, term_frequency int, in_title boolean, max_tf int, "
    "document_size int, positions array<int>, block bigint, slot int, batch bigint, word_bucket int"
)
BOUNDS = "word string, block bigint, top double, pages bigint, batch bigint, word_bucket int"
PAIRS = "word string, url string, positions array<int>, batch bigint, word_bucket int"
FREQUENT = "word string"
KEYWORDS = "word string, document_frequency bigint, batch bigint, word_bucket int"
LINKS = (
    "parent_url string, link_position int, child_url string, batch bigint, child_bucket int"
)
BLOCKS = "block bigint, sizes array<int>, batch bigint"
SUPERSEDED = "url string, superseded_batch bigint, block bigint, slot int, batch bigint"
BATCHES = (
    "source string, epoch bigint, documents bigint, replaced bigint, merged array<bigint>, batch bigint"
)
SETTINGS = "buckets int"
BUCKETS = 16
#: Words whose neighbouring pairs are indexed: those that most pages of a store's first pages
#: hold. The list stays for the life of a store; any other words are found by their postings.
FREQUENT_WORDS = 256
#: Batches of one size class that are merged into one.
FANOUT = 4
#: Pages from which on the postings of a batch are not moved: each task writes its part of every bucket.
MOVED_PAGES = 16_000
#: Bytes of documents whose postings a task then sorts, in memory.
SORTED_BYTES = 16 << 20


def next_merge(sizes: dict[int, int], fanout: int = FANOUT) -> list[int]:
    """Batches to merge next, given their numbers of pages; none if all classes are small.

    A class holds sizes from one power of ``fanout`` to the next. The smallest
    class with ``fanout`` batches gives its oldest ones. So fewer than ``fanout``
    batches of each class are left, and a page is written once per class.
    """
    classes: dict[int, list[int]] = {}
    for batch in sorted(sizes):
        size, level = max(1, sizes[batch]), 0
        while size >= fanout:
            size, level = size // fanout, level + 1
        classes.setdefault(level, []).append(batch)
    full = [level for level, batches in classes.items() if len(batches) >= fanout]
    return classes[min(full)][:fanout] if full else []


class IndexStore:
    """``buckets`` is fixed for the life of a store: aim at about 1 GB of postings each.

    A store that exists knows its number; another one is an error.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        stored = self._small("settings", SETTINGS)
        if stored and buckets not in (None, stored[0].buckets):
            raise ValueError(f"the store has {stored[0].buckets} buckets, not {buckets}")
        self.buckets = stored[0].buckets if stored else buckets or BUCKETS
        self._has_settings = bool(stored)

    # -- reading ---------------------------------------------------------

    def _read(
        self, table: str, schema: str, batches: list[int], session: SparkSession | None = None
    ) -> DataFrame:
        """Rows of the given batches only, so an unfinished one is never seen."""
        if not batches:
            return self.spark.createDataFrame([], schema)
        base = f"{self.root}/{table}"
        paths = [f"{base}/batch={n}" for n in batches]
        return (session or self.spark).read.schema(schema).option("basePath", base).parquet(*paths)

    def _small(self, table: str, schema: str) -> list:
        """All rows of a small table; none if it was never written."""
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{table}").collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []

    def _committed(self) -> list:
        """All batches ever committed, oldest first: one small row each."""
        return sorted(self._small("batches", BATCHES), key=lambda row: row.batch)

    def batches(self) -> list:
        """Batches that are read, oldest first: committed and not merged into another."""
        rows = self._committed()
        gone = {batch for row in rows for batch in row.merged or ()}
        return [row for row in rows if row.batch not in gone]

    def _live(self, table: DataFrame, rows: list, url: str = "url") -> DataFrame:
        """Drop rows of pages that a later batch replaced."""
        gone = self._gone(rows)
        if gone is None:
            return table
        gone = gone.select("url", "batch")
        return table.join(gone.withColumnRenamed("url", url), [url, "batch"], "left_anti")

    def _gone(self, rows: list) -> DataFrame | None:
        """Replaced versions of pages as ``url, batch``; None if there are none."""
        replacing = [row.batch for row in rows if row.replaced]
        if not replacing:
            return None
        return self._read("superseded", SUPERSEDED, replacing).select(
            "url", F.col("superseded_batch").alias("batch"), "block", "slot"
        )

    def _frequent(self) -> tuple[str, ...]:
        return tuple(sorted(row.word for row in self._small("frequent", FREQUENT)))

    def _documents(self, rows: list) -> DataFrame:
        ids = [row.batch for row in rows]
        return self._live(self._read("documents", DOCUMENTS, ids), rows)

    def load(self) -> Index:
        rows = self.batches()
        ids = [row.batch for row in rows]
        keywords = self._read("keywords", KEYWORDS, ids)
        if len(ids) > 1:
            keywords = (
                keywords.groupBy("word", "word_bucket")
                .agg(F.sum("document_frequency").alias("document_frequency"))
                .where("document_frequency > 0")
            )
        n_documents = sum(row.documents - row.replaced for row in rows)
        gone = self._gone(rows)
        return Index(
            documents=self._documents(rows).drop("terms", "block", "slot"),
            postings=self._live(self._read("postings", POSTINGS, ids), rows).drop("batch"),
            all_postings=self._read("postings", POSTINGS, ids),
            replaced=None if gone is None else gone.select("url", "batch"),
            bounds=self._read("bounds", BOUNDS, ids).drop("batch"),
            blocks=self._read("blocks", BLOCKS, ids).drop("batch"),
            dead=None if gone is None else dead_pages(gone),
            pairs=self._read("pairs", PAIRS, ids),
            frequent=self._frequent() if ids else (),
            keywords=keywords.drop("batch"),
            links=self._live(self._read("links", LINKS, ids), rows, "parent_url").drop("batch"),
            corpus=self.spark.range(1).select(F.lit(n_documents).alias("n_documents")),
            buckets=self.buckets,
        )

    def forward(self) -> DataFrame:
        """Live forward-index rows, terms included."""
        return self._documents(self.batches()).drop("block", "slot")

    # -- writing ---------------------------------------------------------

    def _write(self, rows: DataFrame, table: str, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.root}/{table}/batch={batch}")

    def _write_bucketed(
        self, rows: DataFrame, table: str, batch: int, key: str, into: str, *sort: str, move: bool = True
    ) -> None:
        """Write one folder per bucket of ``key``.

        The rebalance hint gathers each bucket, and splits one that a frequent
        word or a popular target has made large into several tasks and files. Without
        ``move`` each task writes what it has of every bucket, for rows that are many enough.
        """
        rows = rows.withColumn(into, bucket(F.col(key), self.buckets))
        (
            (rows.hint("rebalance", into) if move else rows)
            .sortWithinPartitions(into, *sort)
            .write.mode("overwrite")
            .partitionBy(into)
            .parquet(f"{self.root}/{table}/batch={batch}")
        )

    def append(self, analysed: DataFrame, epoch: int, source: str = "batch") -> None:
        """Index a batch of pages, one row per url; replaces pages already known.

        ``modified`` is kept from the known page when the new one has none, and
        ``fetched`` is the time the url was first indexed. An ``epoch`` of a
        ``source`` that is already committed is left as it is; any other one
        comes after all that the store holds, whatever its number. Rows of another store's ``forward``
        are accepted too: as one batch of a new store they make a compact copy.
        """
        committed, known = self._committed(), self.batches()
        if (source, epoch) in {(row.source, row.epoch) for row in committed}:
            return
        if not self._has_settings:
            settings = self.spark.createDataFrame([(self.buckets,)], SETTINGS)
            settings.write.mode("overwrite").parquet(f"{self.root}/settings")
            self._has_settings = True
        batch = committed[-1].batch + 1 if committed else 0
        now = F.current_timestamp()
        first_seen = F.coalesce("fetched", now) if "fetched" in analysed.columns else now
        fresh = analysed.drop("batch", "block", "slot").withColumn("fetched", first_seen)
        replaced = 0
        if known:
            self._write(fresh, "staging", batch)
            fresh = self._read("staging", DOCUMENTS, [batch]).drop("batch", "block", "slot")
            replaced = self._supersede(fresh, known, batch)
        if replaced:
            fresh = self._carry_over(fresh, known, batch)
        self._write(in_blocks(fresh, batch), "documents", batch)

        first = not any(row.documents for row in known)
        self._write_postings(batch)
        changes = self._held(batch).select("word", F.col("pages").alias("change"))
        if replaced:
            old = self._replaced(known, batch)
            changes = changes.unionByName(
                old.select(F.explode("terms.word").alias("word"), F.lit(-1).cast("bigint").alias("change"))
            )
        frequency = (
            changes.groupBy("word")
            .agg(F.sum("change").alias("document_frequency"))
            .where("document_frequency <> 0")
        )
        self._write_bucketed(frequency, "keywords", batch, "word", "word_bucket", "word")
        if first:
            self._choose_frequent(batch)
        forward = self._write_others(batch)
        summary = forward.agg(
            F.lit(source).alias("source"), F.lit(epoch).cast("bigint").alias("epoch"),
            F.count("*").alias("documents"), F.lit(replaced).cast("bigint").alias("replaced"),
            F.lit(None).cast("array<bigint>").alias("merged"),
        )
        self._write(summary, "batches", batch)
        if known:
            remove_folder(self.spark, f"{self.root}/staging/batch={batch}")

    def _written_pages(self, batch: int) -> tuple[DataFrame, bool]:
        """The written documents of a batch, and whether their postings are moved."""
        forward = self._read("documents", DOCUMENTS, [batch]).drop("batch")
        if forward.count() < MOVED_PAGES:
            return forward, True
        return self._in_pieces(batch), False

    def _write_postings(self, batch: int) -> None:
        """Write postings of the written documents of a batch, and bounds of these."""
        pages, move = self._written_pages(batch)
        postings = postings_of(pages, "block", "slot")
        self._write_bucketed(
            postings, "postings", batch, "word", "word_bucket", "word", "block", "url", move=move
        )
        # read where it lies sorted: a word's pages of a block combine before they move
        stored = self._read("postings", POSTINGS, [batch])
        self._write_bucketed(
            block_bounds(stored), "bounds", batch, "word", "word_bucket", "word", "block", move=move
        )

    def _write_others(self, batch: int) -> DataFrame:
        """Write what else follows from the written documents of a batch; returns these."""
        pages, move = self._written_pages(batch)
        forward = self._read("documents", DOCUMENTS, [batch]).drop("batch")
        self._write_bucketed(
            pair_postings(pages, self._frequent()), "pairs", batch, "word", "word_bucket",
            "word", "url", move=move,
        )
        self._write(block_sizes(forward), "blocks", batch)
        self._write_bucketed(
            links_of(forward), "links", batch, "child_url", "child_bucket",
            "child_url", "parent_url",
        )
        return forward

    def _in_pieces(self, batch: int) -> DataFrame:
        """Documents of a batch, so many to a task that sorting their postings need not spill."""
        session = self.spark.newSession()
        session.conf.set("spark.sql.files.maxPartitionBytes", str(SORTED_BYTES))
        return self._read("documents", DOCUMENTS, [batch], session).drop("batch")

    def compact(self, fanout: int = FANOUT) -> int:
        """Merge batches until fewer than ``fanout`` of each size class are left.

        Of n equal batches about ``fanout * log(n)`` remain to be read, and a page
        is written again once per class. Versions that were replaced vanish
        from what is merged. Hits, frequencies and words stay the same. A failed merge
        leaves the store as it was. Folders of merged batches stay for readers that have
        loaded them; :meth:`remove_merged` deletes them. Returns the number of merges.
        """
        merges = 0
        while group := next_merge({row.batch: row.documents for row in self.batches()}, fanout):
            self._merge(group)
            merges += 1
        return merges

    def _merge(self, group: list[int]) -> None:
        batch, rows = self._committed()[-1].batch + 1, self.batches()
        others = [row.batch for row in rows if row.batch not in group]
        live = self._live(self._read("documents", DOCUMENTS, group), rows)
        self._write(in_blocks(live.drop("batch", "block", "slot"), batch), "documents", batch)
        self._write_postings(batch)
        self._write_others(batch)
        # changes of frequency and of the number of pages add up to the same sums
        frequency = (
            self._read("keywords", KEYWORDS, group).groupBy("word")
            .agg(F.sum("document_frequency").alias("document_frequency"))
            .where("document_frequency <> 0")
        )
        self._write_bucketed(frequency, "keywords", batch, "word", "word_bucket", "word")
        merged = [row for row in rows if row.batch in group]
        replaced, replacing = 0, [row.batch for row in merged if row.replaced]
        if replacing and others:
            # what the group replaces in batches that stay
            gone = self._read("superseded", SUPERSEDED, replacing).drop("batch")
            gone = gone.where(F.col("superseded_batch").isin(others))
            self._write(gone, "superseded", batch)
            replaced = self._read("superseded", SUPERSEDED, [batch]).count()
        documents = sum(row.documents - row.replaced for row in merged) + replaced
        summary = self.spark.createDataFrame(
            [("compaction", batch, documents, replaced, group)], BATCHES.rsplit(",", 1)[0]
        )
        self._write(summary.coalesce(1), "batches", batch)

    def remove_merged(self) -> None:
        """Delete the tables of merged batches, once no reader has them loaded."""
        for batch in sorted({n for row in self._committed() for n in row.merged or ()}):
            for table in (
                "documents", "postings", "bounds", "pairs", "blocks", "links", "keywords", "superseded"
            ):
                remove_folder(self.spark, f"{self.root}/{table}/batch={batch}")

    def _held(self, batch: int) -> DataFrame:
        """``word, pages``: numbers of pages of a batch that hold a word, from the bits of blocks."""
        bounds = self._read("bounds", BOUNDS, [batch])
        return bounds.select("word", F.bit_count("pages").cast("bigint").alias("pages"))

    def _choose_frequent(self, batch: int) -> None:
        """The most frequent words of a store's first pages; a further try chooses again."""
        most = self._read("keywords", KEYWORDS, [batch]).orderBy(F.desc("document_frequency"), "word")
        most.limit(FREQUENT_WORDS).select("word").write.mode("overwrite").parquet(
            f"{self.root}/frequent"
        )

    def _supersede(self, fresh: DataFrame, known: list, batch: int) -> int:
        """Record which live pages the batch replaces; return how many."""
        gone = (
            self._documents(known)
            .select("url", F.col("batch").alias("superseded_batch"), "block", "slot")
            .join(fresh.select("url"), "url", "left_semi")
        )
        self._write(gone, "superseded", batch)
        return self._read("superseded", SUPERSEDED, [batch]).count()

    def _replaced(self, known: list, batch: int) -> DataFrame:
        """The earlier forward rows that ``batch`` replaces."""
        gone = self._read("superseded", SUPERSEDED, [batch]).select(
            "url", F.col("superseded_batch").alias("batch")
        )
        ids = [row.batch for row in known]
        return self._read("documents", DOCUMENTS, ids).join(gone, ["url", "batch"], "left_semi")

    def _carry_over(self, fresh: DataFrame, known: list, batch: int) -> DataFrame:
        old = self._replaced(known, batch).select(
            "url", F.col("modified").alias("_modified"), F.col("fetched").alias("_fetched")
        )
        return (
            fresh.join(old, "url", "left")
            .withColumn("modified", F.coalesce("modified", "_modified"))
            .withColumn("fetched", F.coalesce("_fetched", "fetched"))
            .drop("_modified", "_fetched")
        )
