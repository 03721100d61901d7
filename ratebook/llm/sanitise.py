"""Personal data by patterns, and terms that reveal it by co-occurrence.

Base spans are the leftmost non-overlapping matches, per kind, of e-mail
addresses, ip addresses, card numbers (Luhn) and phone numbers. A protected
entity is a span's text, and also what it shares with others of its owner: the
domain of an e-mail address, the first three parts of an ip address, the first
six digits of a card, the first seven of a phone number (``protected``). A word
outside the e-mail addresses of its document is a term. Over the whole corpus,
with D documents, n(t) documents that hold term t, c(e) that hold entity e and
c(e, t) that hold both, however far apart,

    information of e   IC(e)    = log2 (D / c(e))
    disclosure         PMI(e,t) = log2 (c(e, t) D / (c(e) n(t)))

A term whose disclosure is at least ``THRESHOLD`` of the entity's information
(t nearly always points at e), seen with it in at least ``SUPPORT`` documents
of different words (copies of one text are one; both documents of an entity
that only two hold; a single document says nothing of what goes together), is
a span of kind ``term`` wherever it stands in any document, unless it overlaps
a base span: it is to be generalised or removed.

As c(e, t) is at most c(e), such a term has n(t) <= c(e) (D / c(e))^(1 -
``THRESHOLD``): rarer terms alone meet the entities of their documents.

Built-in expressions only. Patterns equal the published ones in what they
match; starts are anchored to the end of the last match or to the first
character of a run, and loops are possessive, so that a long run of one
character class is read once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratebook.llm.common import computed, prepare, staged

# Kinds in order, with their patterns.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?:\G|(?<![0-9]))[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WORD = r"\p{L}[\p{L}\p{N}]++"
SUPPORT = 3
THRESHOLD = 0.8
# Words walked at once when terms are marked, so that a text with many marks
# is not copied once per mark.
BLOCK = 1024
# Matches put into one array before it is set aside.
RUN = 256


def matches(text: Column, pattern: str) -> Column:
    """Array of (start, end, value) of the pattern's matches, in code points:
    the pieces between matches and the matches, laid end to end. Matches are
    gathered ``RUN`` at a time, so that many in one text cost in proportion."""
    laid = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"))
    found = "array<struct<start:int,end:int,value:string>>"

    def step(s: Column, x: Column) -> Column:
        start = s["at"] + F.length(x["gap"])
        end = start + F.coalesce(F.length(x["hit"]), F.lit(0))
        hit = F.struct(start.alias("start"), end.alias("end"), x["hit"].alias("value"))
        run = F.when(x["hit"].isNull(), s["run"]).otherwise(F.concat(s["run"], F.array(hit)))
        full = F.size(s["run"]) >= RUN
        return F.struct(end.alias("at"),
                        F.when(full & x["hit"].isNotNull(), F.array(hit)).otherwise(run).alias("run"),
                        F.when(full & x["hit"].isNotNull(), F.concat(s["runs"], F.array(s["run"]))).otherwise(s["runs"]).alias("runs"))

    begin = F.struct(F.lit(0).alias("at"), F.array().cast(found).alias("run"), F.array().cast(f"array<{found}>").alias("runs"))
    return F.aggregate(laid, begin, step, lambda s: F.flatten(F.concat(s["runs"], F.array(s["run"]))))


def luhn(digits: Column) -> Column:
    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda s, i: s + _luhn_digit(digits, i))
    return total % 10 == 0


def _luhn_digit(digits: Column, i: Column) -> Column:
    d = F.ascii(F.substring(digits, F.length(digits) - i + 1, F.lit(1))) - 48
    twice = d * 2
    return F.when(i % 2 == 1, d).when(twice > 9, twice - 9).otherwise(twice)


def valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        parts = F.transform(F.split(value, r"\."), lambda p: F.ltrim(p, F.lit("0")))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        return F.length(digits).between(12, 19) & luhn(digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """Array of (start, kind order, end, value), by start, then kind."""
    digit = text.rlike("[0-9]")
    guard = {"email": F.contains(text, F.lit("@")), "ip": digit, "card": digit, "phone": F.contains(text, F.lit("+"))}

    def of(order: int, kind: str) -> Column:
        hits = F.filter(matches(text, PATTERNS[kind]), lambda m: valid(kind, m["value"]))
        shaped = F.transform(hits, lambda m: F.struct(
            m["start"].alias("start"), F.lit(order).alias("kind"), m["end"].alias("end"), m["value"].alias("value")))
        return F.when(guard[kind], shaped).otherwise(
            F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>"))

    return F.array_sort(F.concat(*[of(order, kind) for order, kind in enumerate(KINDS)]))


def protected(kind: Column, value: Column) -> Column:
    """What a span of a kind (its order) protects: its own text, lower-cased,
    and the part it shares with others, each marked with the kind."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    shared = (F.when(kind == KINDS.index("email"), F.regexp_replace(F.lower(value), "^.*@", "@"))
              .when(kind == KINDS.index("ip"), F.concat(F.substring_index(value, ".", 3), F.lit(".")))
              .when(kind == KINDS.index("card"), F.substring(digits, 1, 6)).otherwise(F.concat(F.lit("+"), F.substring(digits, 1, 7))))
    name = kind.cast("string")
    return F.array(F.concat_ws(":", name, F.lower(value)), F.concat_ws("/", name, shared))


def _terms(text: Column) -> Column:
    """The distinct words of a text, lower-cased one by one."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda w: F.lower(w)))


def _marked(rows: DataFrame) -> DataFrame:
    """``rows`` (text, base, terms) with ``marks``: array of (start, kind, end)
    of every word that is one of ``terms`` and overlaps no base span."""
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def walk(words: Column) -> Column:
        return F.aggregate(words, F.struct(F.lit(0).alias("at"), empty.alias("out")), lambda s, x: F.struct(
            (s["at"] + F.length(x["gap"]) + F.coalesce(F.length(x["hit"]), F.lit(0))).alias("at"),
            F.when(F.array_contains("terms", F.lower(x["hit"])), F.concat(s["out"], F.array(F.struct(
                (s["at"] + F.length(x["gap"])).alias("start"),
                (s["at"] + F.length(x["gap"]) + F.length(x["hit"])).alias("end"))))).otherwise(s["out"]).alias("out")))

    held = computed(rows, laid=F.arrays_zip(F.split("text", WORD, -1).alias("gap"),
                                            F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("hit"))).drop("text")
    held = computed(held, blocks=F.transform(F.sequence(F.lit(1), F.size("laid"), F.lit(BLOCK)),
                                             lambda b: walk(F.slice("laid", b, BLOCK)))).drop("laid")
    joined = F.aggregate("blocks", F.struct(F.lit(0).alias("at"), empty.alias("out")), lambda s, x: F.struct(
        (s["at"] + x["at"]).alias("at"), F.concat(s["out"], F.transform(x["out"], lambda w: F.struct(
            (w["start"] + s["at"]).alias("start"), (w["end"] + s["at"]).alias("end")))).alias("out")))["out"]
    free = F.filter(joined, lambda w: ~F.exists("base", lambda b: (b["start"] < w["end"]) & (w["start"] < b["end"])))
    return held.withColumn("marks", F.transform(free, lambda w: F.struct(
        w["start"].alias("start"), F.lit(len(KINDS)).alias("kind"), w["end"].alias("end")))).drop("blocks")


def _text_of(spans: Column, kinds: tuple[str, ...]) -> Column:
    names = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: int = SUPPORT,
                  threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, base and all spans as arrays of
    (start, kind, end), kind numbered as in ``KINDS``, then ``term``.

    Null and empty texts have no spans; null ids and repeated rows stay as
    rows, each a document of its own; an empty table gives no rows; other
    columns are ignored."""
    prepare(docs.sparkSession)
    texts = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    made = computed(texts, base=base_spans(F.col("text"))).select("doc_id", "text", "base")
    rows = staged(made.withColumn("rid", F.monotonically_increasing_id()), "spans")

    total = rows.count()
    holds = (rows.where(F.size("base") > 0).select("rid", F.explode("base").alias("b"))
             .select("rid", F.explode(protected(F.col("b.kind"), F.col("b.value"))).alias("entity")).distinct())
    information = F.log2(F.lit(float(total)) / F.col("of_entity"))
    # The bound on n(t) is widened a little: the exact test follows.
    entities = (holds.groupBy("entity").agg(F.count(F.lit(1)).alias("of_entity"))
                .where((F.col("of_entity") >= 2) & (information > 0))
                .withColumn("bound", F.col("of_entity") * F.pow(F.lit(2.0), (1 - threshold) * information) * 1.001))
    holds = staged(holds.join(entities, "entity"), "entities")
    bound = holds.agg(F.coalesce(F.max("bound"), F.lit(0.0))).first()[0]
    held = rows.select("rid", F.explode(_terms(F.col("text"))).alias("term"))
    spread = (held.groupBy("term").agg(F.count(F.lit(1)).alias("of_term"))
              .where(F.col("of_term").between(2, bound)))
    words = F.transform(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), lambda w: F.lower(w))
    outside = F.when(F.contains("text", F.lit("@")), F.regexp_replace("text", PATTERNS["email"], " ")).otherwise(F.col("text"))
    near = computed(rows.where(F.size("base") > 0).join(holds.select("rid").distinct(), "rid", "left_semi").select("rid", "text"),
                    context=F.xxhash64(words), terms=_terms(outside))
    near = near.select("rid", "context", F.explode("terms").alias("term")).join(spread, "term")
    pairs = (near.join(holds, "rid").where(F.col("of_term") <= F.col("bound"))
             .groupBy("entity", "term", "of_entity", "of_term")
             .agg(F.count(F.lit(1)).alias("both"), F.countDistinct("context").alias("contexts"))
             .where(F.col("contexts") >= F.greatest(F.lit(2), F.least(F.lit(support), F.col("of_entity")))))
    disclosure = F.log2(F.col("both") * F.lit(float(total)) / (F.col("of_entity") * F.col("of_term")))
    revealing = staged(pairs.where(disclosure >= threshold * information).select("term").distinct(), "revealing")
    terms_of = staged(held.join(revealing, "term").groupBy("rid").agg(F.collect_set("term").alias("terms")), "terms")
    # A merge join whatever the size: its cost grows in proportion to the texts.
    marks = _marked(rows.select("rid", "text", "base").join(terms_of.hint("merge"), "rid")).select("rid", "marks")
    base = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    return (rows.select("rid", "doc_id", base.alias("base")).join(marks, "rid", "left")
            .select("doc_id", "base", F.when(F.col("marks").isNull(), F.col("base"))
                    .otherwise(F.array_sort(F.concat("base", "marks"))).alias("spans")))


def span_text(spans: Column) -> Column:
    """kind:start:end by start, then kind, comma-joined."""
    return _text_of(spans, (*KINDS, "term"))


def sanitised(text: Column, spans: Column) -> Column:
    """``text`` with each span generalised to its kind in angle brackets;
    spans that begin inside an earlier one go with it."""
    names = F.array(*[F.lit(f"<{k}>") for k in (*KINDS, "term")])
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    walked = F.aggregate(spans, start, lambda a, s: F.when(s["start"] < a["at"], F.struct(
        F.greatest(a["at"], s["end"]).alias("at"), a["out"].alias("out"))).otherwise(F.struct(
            s["end"].alias("at"), F.concat(a["out"], F.substring(text, a["at"] + 1, s["start"] - a["at"]),
                                           F.get(names, s["kind"])).alias("out"))))
    return F.concat(walked["out"], F.substring(text, walked["at"] + 1, F.length(text)))
