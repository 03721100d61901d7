"""Benchmark decontamination by template canonicalisation.

Words are the lower-cased text cut at white space, without punctuation at
their ends. In a template, a number becomes a number slot, a unit after a
number a unit slot, and a capitalised word inside a sentence a name slot;
every other word stands for itself. Windows of ``window`` consecutive template
words of documents and benchmark items are joined by hash. In a matched window
the literal words must agree and the slots must be consistent: one value of the
item always met by one value of the document, and the other way round. A window
that conflicts goes, the others of its alignment (the same offset between a
document and an item) count. So a question with other numbers, names or units
is caught, also where one of them was changed in one place, and windows alike
by chance are not. Items too short for a window, or of slots for the most part,
are matched word for word.

Everything is built-in expressions: one pass over each text makes its words
and window hashes, windows are exploded into the join and vanish there unless
they match. The benchmark side is broadcast when its windows are counted to
at most ``BROADCAST_WINDOWS``, else joined by shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratebook.llm.common import computed, prepare

WINDOW = 8
PIECE = 512
MIN_WINDOWS = 3
SHORTEST = 4
BROADCAST_WINDOWS = 200_000
NAME_MARK = "\u0001"
NAME = r"([\p{L}\p{N},;] )(\p{Lu})"
BLANK = r"[\x20\x09-\x0D]+"
EDGES = ".,;:!?\"'()[]{}<>*_`"
NUMBER = r"^[0-9][0-9.,:/]*%?$"
UNITS = ("mm cm m km in inch inches ft feet yd yards mi mile miles mg g kg lb lbs oz pounds tons tonnes ml l litres "
         "liters gallons s sec seconds min minutes h hr hours day days week weeks month months year years mph kmh hz "
         "w kw j kj v a k c f degrees percent % dollars euros usd eur cents bytes kb mb gb").split()


def words_of(text: Column) -> Column:
    """Words, lower-cased, a name inside a sentence marked in front."""
    marked = F.regexp_replace(F.coalesce(text, F.lit("")), NAME, f"$1{NAME_MARK}$2")
    return F.filter(F.transform(F.split(F.lower(marked), BLANK), lambda w: F.btrim(w, F.lit(EDGES))),
                    lambda w: w != "")


def _numeric(w: Column) -> Column:
    return F.ascii(w).between(48, 57) & w.rlike(NUMBER)


def kinds_of(words: Column) -> Column:
    """Per word: 1 name, 2 number, 3 unit slot, 0 itself."""
    return F.transform(words, lambda w, i: F.when(F.ascii(w) == 1, 1).when(_numeric(w), 2)
                       .when((i > 0) & F.ascii(F.get(words, i - 1)).between(48, 57) & w.isin(UNITS)
                             & _numeric(F.get(words, i - 1)), 3).otherwise(0))


def windows_of(rows: DataFrame, id_col: str, text_col: str, window: int, literal: bool = False) -> DataFrame:
    """(id, first, words, kinds, hashes): a text's template words in pieces of
    at most ``PIECE`` windows from window ``first`` on, and the windows' hashes
    (``literal``: of the words as they stand, slots and name marks aside).
    A piece is what the exploded windows carry, however long the text."""
    words = computed(rows.select(rows[id_col].cast("long").alias("id"), rows[text_col].alias("text")),
                     words=words_of(F.col("text"))).drop("text")
    whole = computed(words, kinds=kinds_of(F.col("words")))
    starts = F.when(F.size("words") >= window, F.sequence(F.lit(1), F.size("words") - (window - 1), F.lit(PIECE)))
    pieces = whole.select("id", F.inline(F.transform(starts, lambda s: F.struct(
        (s - 1).alias("first"), F.slice("words", s, PIECE + window - 1).alias("words"),
        F.slice("kinds", s, PIECE + window - 1).alias("kinds")))))
    template = (F.transform("words", lambda w: F.xxhash64(F.ltrim(w, F.lit(NAME_MARK)))) if literal else
                F.zip_with("words", "kinds", lambda w, k: F.when(k == 0, F.xxhash64(w)).otherwise(k)))
    made = computed(pieces, t=template)
    return computed(made, hashes=F.transform(F.sequence(F.lit(1), F.size("t") - (window - 1)),
                                             lambda i: F.xxhash64(F.slice("t", i, window)))).drop("t")


def _windows(rows: DataFrame, id_col: str, text_col: str, window: int, literal: bool) -> DataFrame:
    """(item_id, j, h, bw, bk): an item's windows one by one, its words and kinds."""
    made = windows_of(rows, id_col, text_col, window, literal)
    made = made.select(F.col("id").alias("item_id"), "first", "words", "kinds", F.posexplode("hashes").alias("p", "h"))
    return made.select("item_id", (F.col("first") + F.col("p")).alias("j"), "h",
                       F.slice("words", F.col("p") + 1, window).alias("bw"),
                       F.slice("kinds", F.col("p") + 1, window).alias("bk")).distinct()


def _met(docs: DataFrame, id_col: str, text_col: str, window: int, literal: bool, items: DataFrame) -> DataFrame:
    """Document windows that meet an item window by hash, with their words."""
    rows = windows_of(docs, id_col, text_col, window, literal)
    met = rows.select(F.col("id").alias("doc_id"), "first", "words", F.posexplode("hashes").alias("p", "h")).join(items, "h")
    # Computed behind the join: the exploded windows run straight into it.
    return computed(met, dw=F.slice("words", F.col("p") + 1, window), i=F.col("first") + F.col("p")).drop("words")


def _verbatim(met: DataFrame, min_windows: int) -> DataFrame:
    """Hits of windows that agree word for word, slot values too."""
    same = F.forall(F.arrays_zip("bw", "dw"), lambda x: F.ltrim(x["bw"], F.lit(NAME_MARK)) == F.ltrim(x["dw"], F.lit(NAME_MARK)))
    filled = F.transform(F.filter(F.arrays_zip("bw", "bk"), lambda x: x["bk"] != 0), lambda x: x["bw"])
    copied = (met.where(same).groupBy("doc_id", "item_id", (F.col("i") - F.col("j")).alias("shift"))
              .agg(F.size(F.collect_set("j")).cast("long").alias("n"), F.max("of").alias("of"),
                   F.size(F.array_distinct(F.flatten(F.collect_set(filled)))).cast("long").alias("slots")))
    return copied.where(F.col("n") >= F.least(F.lit(min_windows), F.col("of"))).select("doc_id", "item_id", "n", "slots")


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                 min_windows: int = MIN_WINDOWS, shortest: int = SHORTEST) -> DataFrame:
    """(doc_id, item_id, n_windows, n_slots): document and item that share at
    least ``min_windows`` item windows (all of a shorter item's) with consistent
    slots on one alignment; the best alignment's figures.

    A window needs at least half its words literal; the minimum is asked of an
    item's windows of that kind. An item without any (a list of numbers, a
    title, all capitals) is matched word for word, slot values too, and so is an
    item of ``shortest`` words or more that is too short for a window, as a
    whole; shorter items match nothing. Documents shorter than what they are
    held against, null and empty texts match nothing; rows with null ids are
    left out; repeated rows and items change nothing; other columns are
    ignored."""
    prepare(docs.sparkSession)
    known = benchmark.where(benchmark[item_col].isNotNull())
    docs = docs.where(docs[id_col].isNotNull())

    every = _windows(known, item_col, item_text_col, window, False)
    fits = F.size(F.filter("bk", lambda k: k == 0)) * 2 >= window
    small = every.limit(BROADCAST_WINDOWS + 1).count() <= BROADCAST_WINDOWS

    def side(df: DataFrame) -> DataFrame:  # with ``small``, at most as many rows as were counted
        return F.broadcast(df) if small else df

    items = every.where(fits)
    of = items.groupBy("item_id").agg(F.countDistinct("j").alias("of"))
    met = _met(docs, id_col, text_col, window, False, side(items))
    agrees = F.forall(F.arrays_zip("bw", "bk", "dw"), lambda x: (x["bk"] != 0) | (x["bw"] == x["dw"]))
    slots = F.transform(F.filter(F.arrays_zip("bw", "bk", "dw"), lambda x: x["bk"] != 0),
                        lambda x: F.struct(x["bw"].alias("b"), x["dw"].alias("d")))
    met = met.where(agrees).select("doc_id", "item_id", "j", (F.col("i") - F.col("j")).alias("shift"),
                                   F.array_distinct(slots).alias("s"))
    one_to_one = ((F.size("s") == F.size(F.array_distinct(F.transform("s", lambda x: x["b"]))))
                  & (F.size("s") == F.size(F.array_distinct(F.transform("s", lambda x: x["d"])))))
    found = (met.where(one_to_one).groupBy("doc_id", "item_id", "shift")
             .agg(F.size(F.collect_set("j")).cast("long").alias("n"),
                  F.array_distinct(F.flatten(F.collect_set("s"))).alias("s")))
    hits = (found.join(side(of), "item_id").where(F.col("n") >= F.least(F.lit(min_windows), F.col("of")))
            .select("doc_id", "item_id", "n", F.size("s").cast("long").alias("slots")))

    dense = every.groupBy("item_id").agg(F.max(fits).alias("any"), F.countDistinct("j").alias("of")).where("not any").drop("any")
    if not dense.isEmpty():
        literal = _windows(known, item_col, item_text_col, window, True).join(dense, "item_id")
        hits = hits.union(_verbatim(_met(docs, id_col, text_col, window, True, side(literal)), min_windows))
    length = F.size(words_of(known[item_text_col]))
    brief = known.select(known[item_col], known[item_text_col], length.alias("__words"))
    # At most window - shortest lengths, each with a pass of its own over the texts.
    for (m,) in brief.where(F.col("__words").between(shortest, window - 1)).select("__words").distinct().orderBy("__words").collect():
        whole = _windows(brief.where(F.col("__words") == m), item_col, item_text_col, m, True).withColumn("of", F.lit(1))
        if whole.limit(BROADCAST_WINDOWS + 1).count() <= BROADCAST_WINDOWS:
            whole = F.broadcast(whole)
        hits = hits.union(_verbatim(_met(docs, id_col, text_col, m, True, whole), 1))
    return hits.groupBy("doc_id", "item_id").agg(F.max("n").alias("n_windows"), F.max("slots").alias("n_slots"))
