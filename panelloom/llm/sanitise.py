"""Personal data: fixed patterns, and terms that reveal the persons they name.

**Base spans.** E-mail and IP addresses, card and phone numbers, leftmost and not overlapping within
a kind; finds that fail their check are dropped. The patterns are written so that the engine neither
backtracks nor recurs over long runs: possessive repeats, and starts that can't lie within a run.

**Revealing terms.** A protected entity is the value of a base span. A term is a word of at least
three letters outside addresses, in lower case. From counts over all documents the disclosure of
entity e by term t is

    log(N n_te / (n_t n_e)) / log(N / n_e)

with N documents, n_e that mention e, n_t that hold t, and n_te that do both, anywhere in the text.
It is 1 for a term that never occurs without e, and about 0 for one that knows nothing of it.

Copies are no evidence. The support of a term is the number of different contexts of e (the ``CONTEXT``
characters around a mention; of several mentions in a document one counts) in the documents that hold
both, or the number of independent texts among these, whichever is less. Texts that have ``SHARED`` or
more of their five-word runs in common are not independent, nor is what such links join; they are found
in shared bands of minima and compared with the least document of the band. A term counts if its
support is ``SUPPORT`` or more, and support times log(N n_te / (n_t n_e)) is ``CERTAINTY`` times log N or
more: of the words of a corpus hardly one would meet e that often by chance, however common e is.

In documents that mention e all occurrences of t are replaced: from ``GENERALISE`` on by a
general word, from ``REMOVE`` on by nothing. In a document that does not mention e the term alone tells
of e with the share n_te / n_t; there it is replaced the same way if that share is ``SURE`` or more.

Everything is built-in Spark functions. Counts are reduced in each task before they are shuffled, an
entity of very many mentions included. Entities with fewer contexts or texts than ``SUPPORT`` can have
no term and go before words are counted. A document's distinct words meet each of its other entities.
Words with their places meet terms by document, or terms that tell alone, of which at most one in
``SURE`` stands outside such documents: never all places of all terms. Texts are shuffled once where
terms were found (not if those places are few enough to be broadcast), else not at all.

Defined results: NULL text counts as empty (and stays NULL when sanitised); rows that repeat a
document give equal results, and each counts as a document; an empty table gives an empty result;
further columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelloom.llm import common as C

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
CONTEXT = 60
BLOCK = 1024
SUPPORT = 3
CERTAINTY = 2
#: Texts that depend on each other: words of a run, share of the runs of two texts that both have, and
#: bands of so many minima each.
SHINGLE = 5
SHARED = 0.5
BANDS = 12
ROWS = 2
GENERALISE = 0.5
REMOVE = 0.8
SURE = 0.5

#: What a text must contain for a pattern to match.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
PATTERNS = {
    # A match starts where a run of local characters starts, or where the last match ended.
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # Digits in groups; a lone digit matches too and fails the check.
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WORD = r"\p{L}{3,}+"
SMALL_PART = r"^0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})$"
REPLACED = {"email": "<email>", "ip": "<ip>", "card": "<card>", "phone": "<phone>", "generalise": "<term>", "remove": ""}

SPANS = "array<struct<begin:int,finish:int,value:string>>"


def let(value: Column, use) -> Column:
    """``use`` of ``value``, which is computed once: inside lambdas it would be for each element."""
    return F.element_at(F.transform(F.array(value), use), 1)


def running(values: Column, zero: Column, combine) -> Column:
    """What ``combine`` makes of all ``values`` (a bound array) before each one. Runs of about the root of
    their number are reduced first, as an array is copied for each slice and each value appended."""
    run = F.ceil(F.sqrt(F.size(values))).cast("int")
    last = F.ceil(F.size(values) / run).cast("int") - 1
    # Of nothing there is no run: a sequence would count down.
    runs = F.when(F.size(values) > 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))

    def part(k: Column) -> Column:
        return F.slice(values, k * run + 1, run)

    def on(out: Column, value: Column) -> Column:
        return F.array_append(out, combine(F.element_at(out, -1), value))

    starts = F.aggregate(F.transform(runs, lambda k: F.aggregate(part(k), zero, combine)), F.array(zero), on)
    # Each run ends with the start of the next, and the starts with the end of all.
    within = F.zip_with(runs, starts, lambda k, start: F.when(k.isNotNull(), F.slice(F.aggregate(part(k), F.array(start), on), F.lit(1), F.size(part(k)))))
    return F.flatten(F.filter(within, lambda out: out.isNotNull()))


def matches(text: Column, pattern: str) -> Column:
    """All matches with begin and finish in code points: what lies between them gives the places."""
    between, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.zip_with(between, found, lambda g, m: F.struct(F.length(g).alias("gap"), F.length(m).alias("size"), m.alias("value")))

    def span(part: Column, before: Column) -> Column:
        begin = before + part["gap"]
        return F.struct(begin.alias("begin"), (begin + part["size"]).alias("finish"), part["value"].alias("value"))

    def placed(parts: Column) -> Column:
        sizes = F.transform(parts, lambda p: p["gap"] + F.coalesce(p["size"], F.lit(0)))
        ends = let(sizes, lambda bound: running(bound, F.lit(0), lambda x, y: x + y))
        return F.filter(F.zip_with(parts, ends, span), lambda s: s["value"].isNotNull())

    return let(parts, placed)


def blocks(text: Column) -> Column:
    """``text`` in blocks of ``BLOCK`` code points: a part of a text is sought from its beginning."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))


def piece(blocks: Column, begin: Column, size: Column) -> Column:
    """``size`` code points from ``begin`` on (fewer at the end) of the text in ``blocks``."""
    first = F.floor(begin / BLOCK).cast("int")
    held = F.slice(blocks, first + 1, F.floor((begin + size) / BLOCK).cast("int") - first + 1)
    return F.substring(F.array_join(held, ""), begin - first * BLOCK + 1, size)


def without_addresses(text: Column) -> Column:
    """``text`` with a blank for each character of an address, the only base spans with letters."""
    found = F.regexp_extract_all(text, F.lit(PATTERNS["email"]), F.lit(0))
    blank = F.zip_with(F.split(text, PATTERNS["email"], -1), found, lambda g, m: F.concat(g, F.coalesce(F.lpad(F.lit(""), F.length(m), " "), F.lit(""))))
    return F.when(F.contains(text, F.lit("@")), F.array_join(blank, "")).otherwise(text)


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda part: part.rlike(SMALL_PART))
    if kind == "card":
        return F.length(digits).between(13, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    hint = F.contains(text, F.lit("@")) if kind == "email" else text.rlike(HINTS[kind])
    found = F.filter(matches(text, PATTERNS[kind]), lambda s: _valid(kind, s["value"]))
    return F.when(hint, found).otherwise(F.array().cast(SPANS))


def entity(kind: Column, value: Column) -> Column:
    """The entity that a value names: lower case, and digits only for numbers."""
    return F.concat(kind, F.lit(":"), F.when(kind.isin("card", "phone"), F.regexp_replace(value, "[^0-9]", "")).otherwise(F.lower(value)))


def with_base(docs: DataFrame, text: str, found: str) -> DataFrame:
    """``docs`` and a struct of the base spans of each kind."""
    plain = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return docs.withColumn(found, F.struct(*[base_spans(plain, k).alias(k) for k in KINDS]))


def _any(found: str) -> Column:
    count = F.lit(0)
    for k in KINDS:
        count = count + F.size(F.col(found)[k])
    return count > 0


def _named(text: Column, base: Column) -> Column:
    """The entities that a text names, each once, with the least hash of their contexts."""

    def of(kind: str, parts: Column) -> Column:
        def one(s: Column) -> Column:
            left = F.greatest(F.lit(0), s["begin"] - CONTEXT)
            around = piece(parts, left, s["finish"] - left + CONTEXT)
            return F.struct(entity(F.lit(kind), s["value"]).alias("entity"), F.xxhash64(around).alias("context"))

        return F.transform(base[kind], one)

    def first_of_each(named: Column) -> Column:
        return F.filter(named, lambda x, i: (i == 0) | (x["entity"] != F.element_at(named, F.greatest(i, F.lit(1)))["entity"]))

    return let(let(blocks(text), lambda parts: F.array_sort(F.concat(*[of(k, parts) for k in KINDS]))), first_of_each)


def _word_runs(text: Column) -> Column:
    """The hashes of the different runs of ``SHINGLE`` words of a text; of fewer words that of all."""

    def runs(words: Column) -> Column:
        last = F.greatest(F.size(words) - SHINGLE, F.lit(0))
        return F.array_distinct(F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.array_join(F.slice(words, i + 1, F.lit(SHINGLE)), " "))))

    return let(F.split(F.trim(F.lower(text)), r"\s+"), runs)


def same_texts(docs: DataFrame) -> DataFrame:
    """(doc_key, same): of ``docs`` (doc_key, text), those that depend on each other with the same number."""
    sets = C.checkpointed(docs.select("doc_key", F.xxhash64("doc_key").alias("id"), _word_runs(F.col("text")).alias("runs")).dropDuplicates(["doc_key"]))

    def band(b: int) -> Column:
        return F.xxhash64(F.lit(b), *[F.array_min(F.transform("runs", lambda r, k=k: F.xxhash64(r, F.lit(b * ROWS + k)))) for k in range(ROWS)])

    cells = C.checkpointed(sets.select("id", F.explode(F.array(*[band(b) for b in range(BANDS)])).alias("cell")))
    leaders = cells.groupBy("cell").agg(F.min("id").alias("b"), F.count("*").alias("n")).where("n > 1")
    pairs = cells.join(leaders, "cell").where("id > b").select(F.col("id").alias("a"), "b").distinct()
    left, right = (sets.select(F.col("id").alias(c), F.col("runs").alias(f"runs_{c}")) for c in ("a", "b"))
    both = F.size(F.array_intersect("runs_a", "runs_b"))
    alike = both >= SHARED * (F.size("runs_a") + F.size("runs_b") - both)
    links = C.checkpointed(pairs.join(left, "a").join(right, "b").where(alike).select("a", "b"))
    same = C.components(links)
    return C.checkpointed(sets.join(same, F.col("id") == F.col("node"), "left").select("doc_key", F.coalesce("component", "id").alias("same")))


def revealing_terms(docs: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    """(entity, term, disclosure, share) of the terms of ``docs`` (doc_key, text) that reveal an
    entity, and (doc_key, entity) of the documents that mention one of these; None without any."""
    words = F.array_distinct(F.transform(F.regexp_extract_all(without_addresses(F.col("text")), F.lit(WORD), F.lit(0)), F.lower))
    held = with_base(docs, "text", "base").where(_any("base"))
    held = C.checkpointed(held.select("doc_key", words.alias("words"), _named(F.col("text"), F.col("base")).alias("named")))
    mentions = held.select("doc_key", F.explode("named").alias("e")).select("doc_key", "e.entity", "e.context")
    known = mentions.groupBy("entity").agg(F.count("*").alias("n_e"), F.count_distinct("context").alias("contexts"))
    known = C.checkpointed(known.where(F.col("contexts") >= SUPPORT).select("entity", "n_e"))
    if C.is_empty(known):
        return None
    asked = C.checkpointed(mentions.join(known.select("entity"), "entity", "left_semi").select("doc_key").distinct())
    texts = same_texts(docs.join(asked, "doc_key", "left_semi"))
    # Rows that repeat a document have one key and one text.
    several = mentions.join(known, "entity").join(texts, "doc_key").groupBy("entity").agg(F.max("n_e").alias("n_e"), F.count_distinct("same").alias("texts"))
    known = C.checkpointed(several.where(F.col("texts") >= SUPPORT).select("entity", "n_e"))
    if C.is_empty(known):
        return None
    own = held.join(texts, "doc_key").select("same", "words", F.explode("named").alias("e")).select("same", "words", "e.entity", "e.context")
    beside = own.join(known.select("entity"), "entity")
    seen = beside.select("entity", "context", "same", F.explode("words").alias("term")).groupBy("entity", "term", "context", "same").agg(F.count("*").alias("docs"))
    support = F.least(F.count_distinct("context"), F.count_distinct("same")).alias("support")
    pairs = seen.groupBy("entity", "term").agg(support, F.sum("docs").alias("n_te"))
    pairs = C.checkpointed(pairs.where(F.col("support") >= SUPPORT))
    # Stored, as a join right above the count would be moved below it, to every word of every text.
    counts = C.checkpointed(docs.select(F.explode(words).alias("term")).groupBy("term").agg(F.count("*").alias("n_t")))
    total = docs.count()
    counted = pairs.join(counts, "term").join(known.where(F.col("n_e") < total), "entity")
    near = F.log(F.lit(total) * F.col("n_te") / (F.col("n_t") * F.col("n_e")))
    whole = F.log(F.lit(total) / F.col("n_e"))
    sure = counted.where(F.col("support") * near >= CERTAINTY * F.log(F.lit(total)))
    scored = sure.select("entity", "term", F.least(F.lit(1.0), near / whole).alias("disclosure"), (F.col("n_te") / F.col("n_t")).alias("share"))
    terms = C.checkpointed(scored.where(F.col("disclosure") >= GENERALISE))
    if C.is_empty(terms):
        return None
    return terms, mentions.join(terms.select("entity").distinct(), "entity", "left_semi").select("doc_key", "entity").distinct()


def term_spans(docs: DataFrame) -> DataFrame | None:
    """doc_key and the places (begin, finish, action) of revealing terms in ``docs`` (doc_key, text)."""
    found = revealing_terms(docs)
    if found is None:
        return None
    terms, mentions = found
    beside = C.checkpointed(mentions.join(terms, "entity").groupBy("doc_key", "term").agg(F.max("disclosure").alias("disclosure")))
    alone = C.checkpointed(terms.where(F.col("share") >= SURE).groupBy("term").agg(F.max("disclosure").alias("disclosure")))

    def places(texts: DataFrame) -> DataFrame:
        words = texts.select("doc_key", F.explode(matches(without_addresses(F.col("text")), WORD)).alias("w"))
        return words.select("doc_key", F.lower("w.value").alias("term"), "w.begin", "w.finish")

    # Only texts of documents that mention an entity meet its terms.
    naming = docs.join(beside.select("doc_key").distinct(), "doc_key", "left_semi")
    spans = places(naming).join(beside, ["doc_key", "term"]).unionByName(places(docs).join(alone, "term"))
    action = F.when(F.max("disclosure") >= REMOVE, "remove").otherwise("generalise")
    spans = spans.groupBy("doc_key", "begin", "finish").agg(action.alias("action"))
    return C.checkpointed(spans.groupBy("doc_key").agg(F.array_sort(F.collect_list(F.struct("begin", "finish", "action"))).alias("terms")))


def find_personal(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", found: str = "personal") -> DataFrame:
    """``docs`` and ``found``: a struct of the base spans by kind and the revealing terms (begin,
    finish and action: generalise or remove)."""
    # A struct of both, not NULL where a part is, so that keys are simply equal.
    body = F.col(f"`{text}`")
    named = F.struct(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).alias("id"), F.col(f"`{doc_id}`").isNull().alias("no_id"), F.xxhash64(body).alias("mark"))
    none = F.array().cast("array<struct<begin:int,finish:int,action:string>>")
    spans = term_spans(docs.select(named.alias("doc_key"), F.coalesce(body, F.lit("")).alias("text")))
    if spans is None:
        return with_base(docs, text, found).withColumn(found, F.col(found).withField(TERM, none))
    key, found_key, terms_found = C.free_name(docs, "doc_key", "found_key", "terms_found")
    places = spans.select(F.col("doc_key").alias(found_key), F.col("terms").alias(terms_found))
    keyed = docs.withColumn(key, named)
    joined = with_base(keyed.join(places, F.col(key) == F.col(found_key), "left"), text, found)
    full = joined.withColumn(found, F.col(found).withField(TERM, F.coalesce(F.col(terms_found), none)))
    return full.drop(key, found_key, terms_found)


def _written(found: str, kinds: tuple[str, ...]) -> Column:
    def written(kind: str) -> Column:
        return F.transform(F.col(found)[kind], lambda s: F.concat_ws(":", F.lit(kind), s["begin"], s["finish"]))

    return F.array_join(F.concat(*map(written, kinds)), ",")


def personal_report(docs: DataFrame) -> DataFrame:
    """doc_id, the number of base spans by kind, base_sha256, and all spans in writing."""
    out = find_personal(docs.select("doc_id", "text"))
    return out.select(
        "doc_id",
        *[F.size(F.col("personal")[k]).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(_written("personal", KINDS), 256).alias("base_sha256"),
        _written("personal", (*KINDS, TERM)).alias("spans"),
    )


def sanitised(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """``docs`` with personal data replaced in ``text``, and ``length`` brought in line with it."""
    (found,) = C.free_name(docs, "personal")
    out = find_personal(docs, doc_id, text, found)

    def replaced(kind: str) -> Column:
        def by(s: Column) -> Column:
            if kind != TERM:
                return F.lit(REPLACED[kind])
            return F.when(s["action"] == "remove", F.lit(REPLACED["remove"])).otherwise(F.lit(REPLACED["generalise"]))

        return F.transform(F.col(found)[kind], lambda s: F.struct(s["begin"].alias("begin"), s["finish"].alias("finish"), by(s).alias("by")))

    body = F.col(f"`{text}`")

    # Spans of different kinds may overlap: what lies within an earlier one goes with it.
    def cut(s: Column, at: Column) -> Column:
        return F.struct(at.alias("at"), F.greatest(s["begin"], at).alias("begin"), s["finish"].alias("finish"), F.when(s["begin"] < at, F.lit("")).otherwise(s["by"]).alias("by"))

    def cuts(every: Column) -> Column:
        reach = let(F.transform(every, lambda s: s["finish"]), lambda ends: running(ends, F.lit(0), lambda x, y: F.greatest(x, y)))
        return F.filter(F.zip_with(every, reach, cut), lambda c: c["finish"] > c["at"])

    def written(cuts: Column) -> Column:
        pieces = let(blocks(body), lambda parts: F.transform(cuts, lambda c: F.concat(piece(parts, c["at"], c["begin"] - c["at"]), c["by"])))
        tail = F.substring(body, F.coalesce(F.try_element_at(cuts, F.lit(-1))["finish"], F.lit(0)) + 1, F.length(body))
        return F.when(F.size(cuts) > 0, F.concat(F.array_join(pieces, ""), tail)).otherwise(body)

    every = F.array_sort(F.concat(*map(replaced, (*KINDS, TERM))))
    clean = F.when(body.isNotNull(), let(let(every, cuts), written))
    changed = {text: clean}
    out = out.withColumns(changed).drop(found)
    if length in docs.columns:
        out = out.withColumn(length, F.coalesce(F.length(F.col(f"`{text}`")).cast(docs.schema[length].dataType), F.col(f"`{length}`")))
    return out.select([F.col(f"`{c}`") for c in docs.columns])
