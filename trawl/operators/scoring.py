"""tf-idf weights, scores and rankings."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trawl.functions.blocks import (
    TITLE_BOOST, bits_of, bits_of_slots, impact, page_bounds, pages_reaching,
)
from trawl.functions.dates import display_date
from trawl.operators.matching import (
    known_terms, on_postings, pages_with_all_phrases, postings_for, urls_are_unique,
)
from trawl.plans.index import Index
from trawl.session import few, slices, unsent, written

# Scores that agree to this many significant digits tie: the order of a
# floating-point sum must not decide a ranking.
SCORE_DIGITS = 9
# Relative distance of bounds that counts as none: wider than the digits compared,
# and than the rounding of bounds to floats.
MARGIN = 1e-6
# Matches that are scored for a first bound, as a multiple of the results wanted.
AHEAD = 4
# Words of a query that a page holds on average, from which on pages are bounded by block.
DENSE_WORDS = 2
# Groups that a task sums up at most, on average: its hash table fits its memory.
SUMMED_ROWS = 2_000_000


def _weighed(index: Index, entries: DataFrame) -> DataFrame:
    """Query words at their postings, with the weight of each."""
    n_documents = index.corpus.scalar()
    idf = F.log2(n_documents / F.col("document_frequency"))
    boost = F.when(F.col("in_title"), TITLE_BOOST).otherwise(1)
    return entries.select(
        "query_id",
        "url",
        "word",
        "term_frequency",
        (F.col("term_frequency") * idf / F.col("max_tf") * boost).alias("weight"),
        "document_size",
        "n_known",
        "n_phrases",
    )


def term_weights(index: Index, parsed: DataFrame) -> DataFrame:
    """Weight of every known query word on every page that holds it.

    The known words are written first: their true size tells Spark whether to
    send them to the postings, which then never move before they are weighed.
    """
    return _weighed(index, postings_for(index, written(known_terms(index, parsed), "terms")))


def _weights_on(index: Index, known: DataFrame, pages: DataFrame) -> DataFrame:
    """Weights of the known words of queries on the given ``query_id, url`` only.

    The postings are joined by word and page: a frequent word costs no more than
    the pages asked for. ``pages`` are a written table.
    """
    wanted = written(known.join(unsent(pages), "query_id"), "wanted")
    keys = [name for name in ("word_bucket", "word") if name in wanted.columns]
    return _weighed(index, on_postings(index, wanted, [*keys, "url"], known))


@dataclass(frozen=True)
class Matches:
    """What a batch of queries matches, before any score; stored once, read by several steps.

    ``known`` are the queries' known words, ``holding`` the pages that hold all phrases of
    the queries that have any, and ``blocks`` (:func:`query_blocks`) where the other
    queries match. Indexes that are not stored have no blocks. With ``by_page`` the blocks
    are not stored, as bounds come from the words that matter (:func:`_reaching_pages`).
    """

    known: DataFrame
    holding: DataFrame | None
    blocks: DataFrame | None
    by_page: bool = False


def _tasks(rows: DataFrame, groups: int) -> int:
    """Tasks over which so many groups are summed up."""
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-groups // SUMMED_ROWS))


def _block_tasks(index: Index, known: DataFrame) -> int:
    queries = known.select("query_id").distinct().count()
    return _tasks(known, queries * index.blocks.count())


def _parts(index: Index, known: DataFrame) -> DataFrame:
    """``query_id, block, part, pages``: what a block holds of each known word of a query.

    The blocks of asked words are dealt by block before queries are joined to them, so what
    moves does not grow with the queries that ask for a word, and groups by query and
    block find their rows where they lie. Too many words to be sent to all tasks meet them by word.
    """
    keys = ["word"] if index.buckets is None else ["word_bucket", "word"]
    idf = F.log2(index.corpus.scalar() / F.col("document_frequency"))
    asked = known.where(F.length("word") > 0)
    if few(asked):
        held = index.bounds.join(asked.select(*keys).distinct(), keys, "left_semi")
        rows = held.repartition(_block_tasks(index, asked), "block").join(F.broadcast(asked), keys)
    else:
        rows = index.bounds.join(asked.hint("merge"), keys)
    return rows.select("query_id", "block", "pages", (F.col("top") * idf / F.col("n_known")).alias("part"))


def _without_dead(index: Index, rows: DataFrame) -> DataFrame:
    """``block, pages``, without the bits of pages that were replaced."""
    if index.dead is None:
        return rows
    gone = F.coalesce("gone", F.lit(0).cast("bigint"))
    return rows.join(index.dead, "block", "left").withColumn(
        "pages", F.col("pages").bitwiseAND(F.bitwise_not(gone))
    )


def _hits() -> Column:
    return F.bit_count("pages").cast("bigint").alias("hits")


def block_hits(index: Index, known: DataFrame) -> DataFrame:
    """``query_id, block, hits``: how many pages of a block hold a known word, without bounds."""
    rows = _parts(index, known).groupBy("query_id", "block").agg(F.bit_or("pages").alias("pages"))
    return _without_dead(index, rows).select("query_id", "block", _hits()).where("hits > 0")


def query_blocks(index: Index, known: DataFrame) -> DataFrame:
    """Blocks of pages that hold a known word: ``query_id, block, bounds, upper, pages, hits``.

    No page of the block scores more than its entry in ``bounds``, the highest of which
    is ``upper``; ``pages`` are the bits of those that match and ``hits`` is their number.
    A query's words are few, so what is gathered of them per block is bounded.
    """
    rows = (
        _parts(index, known)
        .groupBy("query_id", "block")
        .agg(F.collect_list(F.struct("part", "pages")).alias("parts"), F.bit_or("pages").alias("pages"))
        .join(index.blocks, "block")
        .select("query_id", "block", page_bounds(F.col("parts"), F.col("sizes")).alias("bounds"), "pages")
    )
    return _without_dead(index, rows).select(
        "query_id", "block", "bounds", F.array_max("bounds").alias("upper"), "pages", _hits()
    ).where("hits > 0")


def _holding(index: Index, parsed: DataFrame, known: DataFrame) -> DataFrame | None:
    """The pages that hold all phrases of the queries that have any; None without such queries."""
    if not known.where("n_phrases > 0").take(1):
        return None
    phrased = parsed.where(F.size("phrases") > 0)
    return written(pages_with_all_phrases(index, phrased), "holding")


def matches(index: Index, parsed: DataFrame) -> Matches:
    known = written(known_terms(index, parsed), "terms")
    holding, blocks, by_page = _holding(index, parsed, known), None, False
    if index.bounds is not None:
        free = known.where("n_phrases = 0")
        blocks, by_page = query_blocks(index, free), _is_sparse(index, free)
        if not by_page:
            blocks = written(blocks, "query-blocks")
    return Matches(known, holding, blocks, by_page)


def _is_sparse(index: Index, known: DataFrame) -> bool:
    """Whether pages hold so few words of a query that they are looked at one by one.

    A url that the index holds more than once is scored as a whole, but bounded by page;
    bounds by block are taken then.
    """
    asked = known.agg(F.countDistinct("query_id").alias("n"), F.sum("document_frequency").alias("held")).first()
    if not asked.n or asked.held >= DENSE_WORDS * asked.n * index.corpus.first().n_documents:
        return False
    return urls_are_unique(index)


def _summed(weights: DataFrame) -> DataFrame:
    """``query_id, url, score`` from the weights of a page's words.

    The page size and the query's counts are constant within a group, so any
    aggregate returns them.
    """
    totals = weights.groupBy("query_id", "url").agg(
        F.sum("weight").alias("total"),
        F.max("document_size").alias("document_size"),
        F.max("n_known").alias("n_known"),
    )
    return totals.select(
        "query_id",
        "url",
        (F.col("total") / (F.col("document_size") * F.col("n_known"))).alias("score"),
    )


def _weights_by_page(index: Index, known: DataFrame) -> DataFrame:
    """Weights of the known words of queries on all pages, dealt by page.

    The postings of asked words are dealt by page before queries are joined to them, so
    what moves does not grow with the queries that ask for a word, and sums by query and
    page find their rows where they lie. Too many words to be sent to all tasks meet them by word.
    """
    asked = known.where(F.length("word") > 0)
    if not few(asked):
        return _weighed(index, postings_for(index, known))
    keys = ["word"] if index.buckets is None else ["word_bucket", "word"]
    held = on_postings(index, asked.select(*keys).distinct(), keys).select(
        *keys, "url", "term_frequency", "in_title", "max_tf", "document_size"
    )
    return _weighed(index, held.repartition("url").join(F.broadcast(asked), keys))


def _asked_once(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Queries that ask for the same, once each, and ``query_id, same_as`` of all queries.

    Rows that share a ``query_id`` are one query, those without any too.
    """
    asks = F.array_sort(F.collect_list(F.struct("terms", "phrases"))).alias("asks")
    queries = parsed.groupBy("query_id").agg(asks)
    alike = Window.partitionBy("asks", F.col("query_id").isNull())
    named = written(
        queries.select("query_id", F.min("query_id").over(alike).alias("same_as")), "queries"
    )
    once = named.select("same_as").distinct()
    return parsed.join(unsent(once), F.equal_null("query_id", "same_as"), "left_semi"), named


def scores(index: Index, parsed: DataFrame, found: Matches | None = None) -> DataFrame:
    """``query_id, url, score`` of all matching pages, phrases enforced.

    A query with phrases starts from the pages that hold them all; only queries
    without any look at every page that holds one of their words. Queries that ask for
    the same are answered once, and their hits go to each of them.
    """
    if found is not None:
        return _scores_of(index, parsed, found.known, found.holding)
    once, named = _asked_once(parsed)
    once = written(once, "asked")
    hits = _scores_of(index, once, written(known_terms(index, once), "terms"), None)
    hits = hits.withColumnRenamed("query_id", "same_as_hit")
    return hits.join(unsent(named), F.equal_null("same_as_hit", "same_as")).select("query_id", "url", "score")


def _scores_of(
    index: Index, parsed: DataFrame, known: DataFrame, holding: DataFrame | None
) -> DataFrame:
    free = known.where("n_phrases = 0")
    if not known.where("n_phrases > 0").take(1):
        return _summed(_weights_by_page(index, free))
    if holding is None:
        holding = written(pages_with_all_phrases(index, parsed.where(F.size("phrases") > 0)), "holding")
    weights = _weights_on(index, known.where("n_phrases > 0"), holding)
    if free.take(1):
        weights = _weights_by_page(index, free).unionByName(weights)
    return _summed(weights)


def _scores_in(index: Index, known: DataFrame, pages: DataFrame) -> DataFrame:
    """Scores of the given pages (``query_id, block, pages`` as bits) only."""
    wanted = written(known.join(pages, "query_id"), "wanted")
    keys = ["word"] if index.buckets is None else ["word_bucket", "word"]
    entries = on_postings(index, wanted, [*keys, "block"]).where(F.getbit("pages", F.col("slot")) == 1)
    return _summed(_weighed(index, entries))


def _sent(rows: DataFrame) -> DataFrame:
    """``rows`` that many more are joined to, which do not move if these may be sent."""
    return F.broadcast(rows) if few(rows) else rows.hint("merge")


def _word_bounds(index: Index, words: DataFrame, keys: list[str], k: int) -> DataFrame:
    """Per word and whether a title holds it: the ``top`` of its shares in page scores, and ``held`` pages.

    ``kth`` is the word's k-th share on any page, or null if fewer hold it. A share is to be
    multiplied by what the query contributes.
    """
    share = (impact() / F.greatest("document_size", F.lit(1))).alias("share")
    shares = on_postings(index, words, keys).select(*keys, "in_title", share)
    best = Window.partitionBy(*keys).orderBy(F.desc("share"))
    kth = shares.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= k)
    kth = kth.where(F.col("_n") == k).select(*keys, F.col("share").alias("kth"))
    tops = shares.groupBy(*keys, "in_title").agg(F.max("share").alias("top"), F.count("*").alias("held"))
    return written(tops.join(kth, keys, "left"), "word-bounds")


def _essential(index: Index, known: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The words of queries of which a page among the first ``k`` holds at least one.

    The k-th share of any word of a query is a lower bound of its k-th score (``least``).
    Words, in titles or not, whose tops do not add up to it are left out, from the lowest one
    on; ``rest`` is what they can add to a page.
    """
    words = _word_bounds(index, _sent(known.select(*keys).distinct()), keys, k)
    times = F.log2(index.corpus.scalar() / F.col("document_frequency")) / F.col("n_known")
    per_query = Window.partitionBy("query_id")
    upwards = per_query.orderBy("part", "word", "in_title").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    parts = (
        known.join(unsent(words), keys)
        .withColumn("times", times)
        .withColumn("part", F.col("top") * F.col("times"))
        .withColumn("least", F.max(F.col("kth") * F.col("times")).over(per_query) * (1 - MARGIN))
        .withColumn("_matters", F.coalesce(F.sum("part").over(upwards) >= F.col("least"), F.lit(True)))
        .withColumn("rest", F.sum(F.when(F.col("_matters"), 0.0).otherwise(F.col("part"))).over(per_query))
    )
    return written(
        parts.where("_matters").select("query_id", *keys, "in_title", "times", "least", "rest", "held"),
        "essential",
    )


def _reaching_pages(index: Index, known: DataFrame, k: int) -> DataFrame:
    """``query_id, block, pages`` of pages that can be among the first ``k``, from essential words only.

    The postings of essential words are dealt by page, queries are sent to them, and a
    page is kept if what these words give it, with all that others can add, reaches the
    lower bound. The k-th of these sums is a second lower bound. Queries come in slices that may
    be sent whole; what is stored are pages that reach a bound, never all that match.
    """
    keys = ["word"] if index.buckets is None else ["word_bucket", "word"]
    share = (impact() / F.greatest("document_size", F.lit(1))).alias("share")
    by_sum = Window.partitionBy("query_id").orderBy(F.desc("sum"))
    found = []
    for essential in slices(_essential(index, known, keys, k), "query_id"):
        asked = _sent(essential.select(*keys, "in_title").distinct())
        held = on_postings(index, asked, [*keys, "in_title"])
        tasks = _tasks(held, essential.agg(F.sum("held")).first()[0] or 0)
        held = held.select(*keys, "in_title", "block", "slot", share).repartition(tasks, "block", "slot")
        sums = written(
            held.join(_sent(essential.drop("held")), [*keys, "in_title"])
            .groupBy("query_id", "block", "slot")
            .agg(
                F.sum(F.col("share") * F.col("times")).alias("sum"),
                F.max("least").alias("least"), F.max("rest").alias("rest"),
            )
            .where("least IS NULL OR sum + rest >= least")
            .drop("least"),
            "sums",
        )
        least = (
            sums.withColumn("_n", F.row_number().over(by_sum)).where(F.col("_n") <= k)
            .where(F.col("_n") == k)
            .select("query_id", (F.col("sum") * (1 - MARGIN)).alias("least"))
        )
        least = written(least, "least")
        found.append(written(
            sums.join(_sent(least), "query_id", "left")
            .where("least IS NULL OR sum + rest >= least")
            .groupBy("query_id", "block").agg(bits_of_slots().alias("pages")),
            "reaching",
        ))
    pages = found[0]
    for more in found[1:]:
        pages = pages.unionByName(more)
    return pages


def contenders(index: Index, found: Matches, k: int) -> DataFrame:
    """Scores of all pages that can be among the first ``k`` of their query.

    Of the ``k`` blocks with the highest bounds, the ``AHEAD * k`` pages with the highest
    bounds are scored first. Their k-th score is a lower bound of the k-th score of
    all; pages whose own bound is below it are never scored, and blocks without any
    other page are never looked up. The margin is wider than the digits that
    rankings compare (``SCORE_DIGITS``), so ties are all found. Many short queries find their
    pages by word instead (:func:`_reaching_pages`), as most of their blocks would hold none.
    """
    known = found.known.where("n_phrases = 0")
    if found.by_page:
        return _with_phrased(index, found, _scores_in(index, known, unsent(_reaching_pages(index, known, k))))
    by_bound = Window.partitionBy("query_id").orderBy(F.desc("upper"), "block")
    # k blocks hold k matches or more; Spark keeps k rows per query and task
    best = found.blocks.withColumn("_n", F.row_number().over(by_bound)).where(F.col("_n") <= k)
    alike = (
        best.select("query_id", "block", "pages", F.posexplode("bounds").alias("slot", "bound"))
        .where(F.getbit("pages", F.col("slot")) == 1)
        .withColumn("_n", F.row_number().over(
            Window.partitionBy("query_id").orderBy(F.desc("bound"), "block", "slot")
        ))
        .where(F.col("_n") <= AHEAD * k)
    )
    first = written(
        alike.groupBy("query_id", "block").agg(bits_of(F.collect_list("slot")).alias("pages")), "first-pages"
    )
    scored = written(_scores_in(index, known, unsent(first)), "first-hits")
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"))
    least = (
        scored.withColumn("_n", F.row_number().over(by_score)).where(F.col("_n") <= k)
        .where(F.col("_n") == k)
        .select("query_id", (F.col("score") * (1 - MARGIN)).alias("least"))
    )
    done = first.select("query_id", "block", F.col("pages").alias("done"))
    reaching = F.when(F.col("least").isNull(), F.col("pages")).otherwise(
        pages_reaching(F.col("bounds"), F.col("least")).bitwiseAND(F.col("pages"))
    )
    rest = (
        found.blocks.join(written(least, "least"), "query_id", "left")
        .where(F.col("least").isNull() | (F.col("upper") >= F.col("least")))
        .join(unsent(done), ["query_id", "block"], "left")
        .select("query_id", "block", reaching.bitwiseAND(
            F.bitwise_not(F.coalesce("done", F.lit(0).cast("bigint")))
        ).alias("pages"))
        .where("pages <> 0")
    )
    return _with_phrased(index, found, scored.unionByName(_scores_in(index, known, rest)))


def _with_phrased(index: Index, found: Matches, hits: DataFrame) -> DataFrame:
    if found.holding is None:
        return hits
    phrased = found.known.where("n_phrases > 0")
    return hits.unionByName(_summed(_weights_on(index, phrased, found.holding)))


def significant(value: Column, digits: int = SCORE_DIGITS) -> Column:
    """``value``, 0 or more, by exponent and rounded digits: comparable at any size."""
    power = F.floor(F.log10(value)).cast("int")
    lead = F.round(value / F.pow(F.lit(10.0), power), digits - 1)
    # 9.99... rounds up to the next power of ten
    over = lead >= 10
    return F.when(value > 0, F.struct(
        F.when(over, power + 1).otherwise(power).alias("power"),
        F.when(over, lead / 10).otherwise(lead).alias("lead"),
    )).otherwise(F.struct(F.lit(-400).alias("power"), F.lit(0.0).alias("lead")))


def _by_score() -> Column:
    return significant(F.col("score")).desc()


def rank_order() -> list[Column]:
    """Best first: score, then title, date text and size downwards, then url."""
    return [
        _by_score(),
        F.desc("title"),
        F.desc_nulls_last("modified_text"),
        F.desc("document_size"),
        F.asc("url"),
    ]


def _described(index: Index, hits: DataFrame) -> DataFrame:
    documents = index.documents.select(
        "url", "title", display_date(F.col("modified")).alias("modified_text"), "document_size"
    )
    return hits.join(documents, "url")


def all_results(index: Index, parsed: DataFrame) -> DataFrame:
    """Every match of every query, sorted by query and rank order."""
    return _described(index, scores(index, parsed)).orderBy("query_id", *rank_order())


def top_results(
    index: Index, parsed: DataFrame, k: int = 50, found: Matches | None = None
) -> DataFrame:
    """The first ``k`` results per query with their 1-based ``position``.

    ``found`` are the matches of the queries, should they be at hand already. Where the
    index has bounds by block, only pages that can be among the first are scored
    (:func:`contenders`).

    A query's k-th best score is found first; hits that reach it, ties included,
    then get their page details, which settle the order. Both rankings number
    rows without ties, so Spark keeps at most ``k`` rows per query and task
    before it shuffles, even for a query that every page matches equally well.
    """
    found = matches(index, parsed) if found is None else found
    some = scores(index, parsed, found) if found.blocks is None else contenders(index, found, k)
    hits = written(some, "hits")
    per_query = Window.partitionBy("query_id")
    thresholds = (
        hits.select("query_id", "score")
        .withColumn("_n", F.row_number().over(per_query.orderBy(_by_score())))
        .where(F.col("_n") <= k)
        .groupBy("query_id")
        .agg(F.min(significant(F.col("score"))).alias("_least"))
    )
    reaching = (
        hits.join(written(thresholds, "thresholds"), "query_id")
        .where(significant(F.col("score")) >= F.col("_least"))
        .drop("_least")
    )
    return (
        _described(index, reaching)
        .withColumn("position", F.row_number().over(per_query.orderBy(*rank_order())))
        .where(F.col("position") <= k)
    )


def _count_by_slices(index: Index, known: DataFrame) -> DataFrame:
    """``query_id, n``, counted for as many queries at a time as may be sent to all blocks."""
    counts = None
    for some in slices(known, "query_id"):
        n = written(block_hits(index, some).groupBy("query_id").agg(F.sum("hits").alias("n")), "counts")
        counts = n if counts is None else counts.unionByName(n)
    return counts


def hit_counts(
    index: Index, parsed: DataFrame, k: int = 50, found: Matches | None = None
) -> DataFrame:
    """Per query the number of matches and its label; 0 for a query without any.

    Where the index has bounds by block, matches are counted by the bits of its pages,
    or as the pages that hold all phrases, and nothing is scored.
    """
    if found is None:
        known = written(known_terms(index, parsed), "terms")
        holding = _holding(index, parsed, known)
        found = Matches(known, holding, None)
        blocks = None if index.bounds is None else block_hits(index, known.where("n_phrases = 0"))
    else:
        blocks, holding = found.blocks, found.holding
    if blocks is None:
        counts = scores(index, parsed, found).groupBy("query_id").agg(F.count("*").alias("n"))
    else:
        if found.by_page:
            counts = _count_by_slices(index, found.known.where("n_phrases = 0"))
        else:
            counts = blocks.groupBy("query_id").agg(F.sum("hits").alias("n"))
        if holding is not None:
            counts = counts.unionByName(holding.groupBy("query_id").agg(F.count("*").alias("n")))
    total = F.coalesce("n", F.lit(0))
    label = F.when(total > k, F.concat(total.cast("string"), F.lit(f" ({k} shown)"))).otherwise(
        total.cast("string")
    )
    return parsed.select("query_id", "query").join(counts, "query_id", "left").select(
        "query_id", "query", total.alias("total"), label.alias("total_results")
    )


def matched_keywords(index: Index, parsed: DataFrame, results: DataFrame) -> DataFrame:
    """Map of matched word to term frequency for the given results only."""
    known = written(known_terms(index, parsed), "terms")
    entries = _weights_on(index, known, results.select("query_id", "url"))
    return entries.groupBy("query_id", "url").agg(
        F.map_from_entries(
            F.array_sort(F.collect_list(F.struct("word", "term_frequency")))
        ).alias("keywords")
    )
