"""Benchmark decontamination through a distributed positional inverted index.

The index stores one posting for each place of a document that holds a term of the tests: (doc_id, key, term, place).
Documents can be read in any split, and a posting never depends on another task. A phrase is found by intersecting
offset-adjusted posting lists, from its rarest term on: lists of the two rarest terms give candidates, which are then
checked against the lists of all other terms. All of it is DataFrame operations.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrears_mart.llm.columns import ascii_lower, broadcast_if_small, fields, row_key, whole_row
from arrears_mart.stages import stage_table

#: Fixed by the contract: runs of digits, lower-case letters and everything beyond ASCII, after A-Z are lower-cased.
_GAP = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_END = "#"  # no term; its posting stands one place beyond the last term and so holds a document's length
_SLOTS = 1 << 20  # documents with candidates are pre-selected by one of so many hash slots


def terms(text: Column) -> Column:
    """The terms of a text, in order; none for null."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), _GAP), "")


def test_windows(tests: DataFrame, id_col: str, text_col: str, length: int) -> DataFrame:
    """(item_id, window, offset, term, size): every run of `length` terms of an item, or all if it has fewer."""
    listed = tests.select(F.col(id_col).alias("item_id"), terms(F.col(text_col)).alias("terms"))
    listed = listed.where(F.size("terms") > 0).distinct()
    starts = F.sequence(F.lit(0), F.greatest(F.size("terms") - length, F.lit(0)))
    cut = listed.select("item_id", "terms", F.explode(starts).alias("start"))
    cut = cut.select("item_id", F.slice("terms", F.col("start") + 1, length).alias("terms"))
    # A window that several items share is searched once.
    cut = cut.groupBy("terms").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    cut = cut.select(F.xxhash64("terms").alias("window"), "terms", "items")
    return cut.select("window", "items", F.size("terms").alias("size"), F.posexplode("terms").alias("offset", "term"))


def build_index(docs: DataFrame, vocabulary: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stored postings (doc_id, key, term_id, place) of the vocabulary (term, term_id) in whole documents.

    Each document also has a posting of `_END` at the place beyond its last term. The vocabulary comes from the test
    set and is broadcast if its measured size allows; else the join shuffles.
    """
    text = F.col(text_col)
    listed = docs.select(
        F.col(id_col).alias("doc_id"), row_key(text).alias("key"), F.concat(terms(text), F.array(F.lit(_END))).alias("terms")
    )
    places = listed.select("doc_id", "key", F.posexplode("terms").alias("place", "term"))
    found = places.join(broadcast_if_small(vocabulary), "term")
    return stage_table(found.select("doc_id", "key", "term_id", "place"), "phrase-index")


def vocabulary_of(windows: DataFrame) -> DataFrame:
    """Stored (term, term_id) of the windows' terms and the end mark, which has number 0."""
    found = windows.select("term").distinct().select("term", (F.monotonically_increasing_id() + 1).alias("term_id"))
    end = windows.sparkSession.range(1).select(F.lit(_END).alias("term"), F.col("id").alias("term_id"))
    return stage_table(found.union(end).coalesce(1), "phrase-vocabulary")


def _at(left: str, right: str, names: Sequence[str]) -> Column:
    return F.expr(" and ".join(f"{left}.{n} <=> {right}.{n}" for n in ("doc_id", *names)))


_START = ["key", "start", "window"]


def _ranked(index: DataFrame, windows: DataFrame) -> DataFrame:
    """The places of each window with their term's rank, the rarest in the corpus first."""
    counts = index.where("term_id > 0").groupBy("term_id").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("window").orderBy(F.coalesce("n", F.lit(0)), "term_id", "offset")
    return windows.join(counts, "term_id", "left").withColumn("rank", F.row_number().over(order))


def _postings_at(index: DataFrame, ranked: DataFrame, rank: int) -> DataFrame:
    """Posting lists of each window's term of this rank, moved to where the window would start."""
    one = stage_table(ranked.where(F.col("rank") == rank).select("window", "size", "offset", "term_id"), "phrase-rank")
    lists = index.join(broadcast_if_small(one), "term_id")
    return lists.select("doc_id", "key", (F.col("place") - F.col("offset")).alias("start"), "window", "size")


def _near(index: DataFrame, found: DataFrame) -> DataFrame:
    """Postings of documents in `found`, and few others: those whose hash slot, of a fixed number, is not among theirs
    are left out before any shuffle."""
    slot = F.pmod(F.xxhash64("doc_id", "key"), F.lit(_SLOTS)).cast("int")
    slots = stage_table(found.select(slot.alias("slot")).distinct(), "phrase-slots")
    return index.withColumn("slot", slot).join(F.broadcast(slots), "slot", "left_semi").drop("slot")


def find_phrases(index: DataFrame, windows: DataFrame) -> DataFrame:
    """(doc_id, key, start, window, size): all exact occurrences of the windows, each once.

    `windows` has (window, size, offset, term_id), one row for each place of a window.
    """
    ranked = stage_table(_ranked(index, windows), "phrase-ranked")
    rarest, second = _postings_at(index, ranked, 1).where("start >= 0"), _postings_at(index, ranked, 2)
    pairs = rarest.alias("a").join(second.alias("b"), _at("a", "b", _START), "left_semi")
    found = stage_table(rarest.where("size = 1").union(pairs).distinct(), "phrase-candidates")
    others = stage_table(ranked.where("rank > 2").select("window", "offset", "term_id"), "phrase-others")
    wanted = found.join(broadcast_if_small(others), "window").select(
        "doc_id", *_START, "term_id", (F.col("start") + F.col("offset")).alias("place")
    )
    held = wanted.alias("w").join(_near(index, found).alias("i"), _at("w", "i", ["key", "place", "term_id"]), "left_semi")
    counted = held.groupBy("doc_id", *_START).agg(F.count(F.lit(1)).alias("held"))
    checked = found.alias("f").join(counted.alias("c"), _at("f", "c", _START), "left")
    return checked.where("coalesce(c.held, 0) = greatest(f.size - 2, 0)").select("f.*")


def find_proximity(index: DataFrame, windows: DataFrame, slack: int) -> DataFrame:
    """(doc_id, key, start, window, size): places where all terms of a window stand, in any order, within its length and
    `slack` more places on either side. `start` is where the window would begin, told by its rarest term.

    Terms are looked up by document and stretch of text, so that a frequent term in a long document costs no more than
    its postings nearby.
    """
    ranked = stage_table(_ranked(index, windows), "phrase-ranked")
    found = stage_table(_postings_at(index, ranked, 1).distinct(), "phrase-candidates")
    sizes = windows.agg(F.max("size")).first()[0]
    width = (sizes or 1) + 2 * slack
    distinct_terms = stage_table(windows.select("window", "term_id").distinct(), "phrase-terms")
    needed = distinct_terms.groupBy("window").agg(F.count(F.lit(1)).alias("needed"))
    low, high = F.greatest(F.col("start") - slack, F.lit(0)), F.col("start") + F.col("size") + (slack - 1)
    stretch = F.explode(F.sequence(F.floor(low / width), F.floor(F.greatest(low, high) / width)))
    wanted = found.join(broadcast_if_small(distinct_terms), "window").select(
        "doc_id", *_START, "size", "term_id", low.alias("low"), high.alias("high"), stretch.alias("stretch")
    )
    near = _near(index, found).withColumn("stretch", F.floor(F.col("place") / width))
    held = wanted.alias("w").join(near.alias("i"), _at("w", "i", ["key", "term_id", "stretch"]))
    held = held.where("i.place between w.low and w.high").select("w.doc_id", *[f"w.{n}" for n in _START], "w.size", "w.term_id")
    counted = held.distinct().groupBy("doc_id", *_START, "size").agg(F.count(F.lit(1)).alias("held"))
    return counted.join(needed, "window").where("held = needed").select("doc_id", *_START, "size")


def decontaminate(
    docs: DataFrame, tests: DataFrame, length: int = 10, id_col: str = "doc_id", text_col: str = "text", test_id: str = "item_id"
) -> DataFrame:
    """Per row of `docs`: doc_id, key, n_words, n_hit, n_items, items (sorted texts), contaminated.

    A word is hit if it lies in any occurrence of a run of `length` test words; a shorter item is searched whole. Null,
    empty and wordless texts have no words and no hits; wordless items are never found. Repeated documents give repeated
    rows. Items without an id count for hits and are not listed. Without documents the result is empty; without items
    nothing is hit.
    """
    listed = stage_table(test_windows(tests, test_id, text_col, length), "phrase-windows")
    vocabulary = vocabulary_of(listed)
    places = listed.join(vocabulary, "term").select("window", "size", "offset", "term_id")
    index = build_index(docs, vocabulary, id_col, text_col)
    found = stage_table(find_phrases(index, places), "phrase-found")
    hit = found.select("doc_id", "key", F.explode(F.expr("sequence(start, start + size - 1)")).alias("place")).distinct()
    hit = hit.groupBy("doc_id", "key").agg(F.count(F.lit(1)).alias("n_hit"))
    items = listed.where("offset = 0").select("window", F.explode_outer("items").alias("item"))
    named = found.select("doc_id", "key", "window").distinct().join(items, "window")
    # An array holds at most the items of the test set.
    named = named.groupBy("doc_id", "key").agg(F.sort_array(F.collect_set(F.col("item").cast("string"))).alias("items"))
    result = hit.alias("h").join(named.alias("n"), _at("h", "n", ["key"])).select("h.*", "n.items")
    all_docs = index.where("term_id = 0").select("doc_id", "key", F.col("place").cast("long").alias("n_words"))
    return all_docs.alias("d").join(result.alias("r"), _at("d", "r", ["key"]), "left").select(
        "d.doc_id",
        "d.key",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    ).withColumn("n_items", F.size("items").cast("long"))


def without_contaminated(docs: DataFrame, tests: DataFrame, **options) -> DataFrame:
    """The rows of `docs` that hold no run of test words, with their columns as they are, whatever their names.

    Null, empty and wordless texts hold none and stay; repeated rows stay or go together. Long texts are read whole, an
    empty table gives an empty result, and without items every row stays.
    """
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    bad = decontaminate(docs, tests, **options).where("contaminated").select("doc_id", "key").distinct()
    bad = stage_table(bad, "phrase-contaminated")
    marked = docs.select(F.col(id_col).alias("id"), row_key(F.col(text_col)).alias("text_key"), whole_row(docs).alias("row"))
    same = marked.id.eqNullSafe(bad["doc_id"]) & (marked.text_key == bad["key"])
    return marked.join(bad, same, "left_anti").select(*fields("row", docs.columns))
