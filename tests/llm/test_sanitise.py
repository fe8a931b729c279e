"""Personal data: base spans equal those of the plain patterns; revealing terms; sanitised texts."""

import collections
import hashlib
import math
import random
import re
import time

from pyspark.sql import functions as F

from panelloom.llm import sanitise

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def brute(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if (
                kind == "email"
                or (kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")))
                or (kind == "card" and 13 <= len(digits) <= 19 and luhn(digits))
                or (kind == "phone" and 9 <= len(digits) <= 15)
            ):
                out.append((kind, m.start(), m.end()))
    return out


PARTS = ["a@b.c", "%x@d.e", "@", ".", "1.2.3.4", "256.1.1.1", "1.2.3", "4111 1111 1111 1111", "4111111111111111", "4", "-", " ", "+1 (555) 123-4567", "+", "é", "\U0001f600", "a", "%", "_b", "12", "5", "+44", ".5", "\n", "4111-1111-1111-1111-", "0", "x.y-z@q-r.com.", "00255.0.0.1"]


def compare(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS personal", "2 AS doc_key")
    got = {r.doc_id: r for r in sanitise.personal_report(df).collect()}
    assert len(got) == len(rows)
    for d, text in rows:
        spans = brute(text)
        written = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        r = got[d]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[0] == k for s in spans) for k in PLAIN), text
        assert r.base_sha256 == hashlib.sha256(written.encode()).hexdigest() and r.spans.startswith(written), text


def test_random_texts(spark):
    rnd = random.Random(5)
    rows = [(k, "".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 25)))) for k in range(1500)]
    compare(spark, rows + [(4000, None), (4001, ""), (None, "x@y.z"), (4002, "1 " * 2000), (4003, "1." * 2000), (4004, "a@b.c " * 300)])


def test_long_runs_neither_recur_nor_backtrack(spark):
    rows = [(0, "1 " * 60_000), (1, "a" * 300_000 + "@"), (2, "1" * 300_000), (3, "+1" + "(" * 100_000), (4, "1.2.3" * 30_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = sanitise.with_base(df, "text", "f").selectExpr("doc_id", "size(f.email) + size(f.card) + size(f.phone) n").collect()
    assert {r.doc_id: r.n for r in found} == {0: 0, 1: 0, 2: 0, 3: 0, 4: 0}


def crowd():
    filler = ["alpha", "beta", "gamma", "delta", "omega", "sigma"]
    rows = [(k, f"{filler[k % 6]} {filler[k // 6]} note: Waldemar wrote from jw@corp.com about {filler[(k * 7) % 6]} today") for k in range(12)]
    rows += [(100 + k, f"{filler[k % 6]} {filler[(k + 1) % 6]} wrote about {filler[(k + 2) % 6]} today note from") for k in range(60)]
    return rows


def test_terms_that_reveal_an_entity(spark):
    rows = crowd() + [(500, "Waldemar is named without a mention")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r for r in sanitise.find_personal(df).collect()}
    shown = {rows[0][1][s.begin : s.finish].lower(): s.action for s in out[0].personal.term}
    assert shown.get("waldemar") == "remove"
    assert not {"today", "wrote"} & set(shown)
    assert not out[100].personal.term
    # Named without a mention, the term still tells of the entity.
    assert [(s.begin, s.finish, s.action) for s in out[500].personal.term] == [(0, 8, "remove")]


def plain_terms(rows):
    """Places of revealing terms by document, counted in plain loops over all documents."""

    def words(text):
        masked = re.sub(PLAIN["email"], lambda m: " " * len(m[0]), text)
        return [(m[0].lower(), m.start(), m.end()) for m in re.finditer(r"[^\W\d_]{3,}", masked)]

    held, beside, around = collections.Counter(), collections.Counter(), collections.defaultdict(set)
    naming, entities = collections.Counter(), []
    for _, text in rows:
        text, mentions = text or "", collections.defaultdict(list)
        for kind, a, b in brute(text):
            value = text[a:b].lower() if kind in ("email", "ip") else re.sub("[^0-9]", "", text[a:b])
            mentions[kind, value].append(text[max(0, a - sanitise.CONTEXT) : b + sanitise.CONTEXT])
        entities.append(set(mentions))
        terms = {w[0] for w in words(text)}
        held.update(terms)
        naming.update(mentions.keys())
        for e, contexts in mentions.items():
            # One context stands for a document; rows of these tests hold one mention of each entity.
            assert len(set(contexts)) == 1
            for t in terms:
                beside[e, t] += 1
                around[e, t].add(contexts[0])
    n, scores = len(rows), {}
    for (e, t), both in beside.items():
        if len(around[e, t]) >= sanitise.SUPPORT and naming[e] < n:
            near = math.log(n * both / (held[t] * naming[e]))
            score = near / math.log(n / naming[e])
            if score >= sanitise.GENERALISE and len(around[e, t]) * near >= sanitise.CERTAINTY * math.log(n):
                scores[e, t] = (min(1.0, score), both / held[t])
    out = []
    for (d, text), named in zip(rows, entities):
        spans = []
        for t, a, b in words(text or ""):
            best = [s for (e, u), (s, share) in scores.items() if u == t and (e in named or share >= sanitise.SURE)]
            if best:
                spans.append((a, b, "remove" if max(best) >= sanitise.REMOVE else "generalise"))
        out.append((d, spans))
    return out


def found_terms(df):
    return sorted(((r.doc_id, [(s.begin, s.finish, s.action) for s in r.personal.term]) for r in sanitise.find_personal(df).collect()), key=repr)


def test_disclosure_equals_plain_counts(spark):
    rnd = random.Random(11)
    names = ["Waldemar", "Ångström", "Kościuszko", "Émile", "Renée", "Ulrike"]
    addresses = ["jw@corp.com", "a.b@x.org", "10.1.2.3", "+1 (555) 123-4567", "4111 1111 1111 1111", "zoë@y.net"]
    common = [f"{a}{b}" for a in ("lorem", "dolor", "amet", "sed") for b in ("um", "is", "or", "ex", "ad")]
    rows = []
    for k in range(400):
        words = rnd.choices(common, k=rnd.randint(5, 60))
        for i in rnd.sample(range(6), rnd.choice([0, 0, 1, 2])):
            words.insert(rnd.randint(0, len(words)), addresses[i] + ",")
            if rnd.random() < 0.8:
                words.insert(rnd.randint(0, len(words)), names[i])
        if rnd.random() < 0.03:
            words.append(rnd.choice(names))
        # Known in more texts than those of its address.
        if rnd.random() < 0.15:
            words.append("Émile")
        rows.append((k, " ".join(words)))
    rows += [rows[3], rows[7], (None, "Waldemar once more"), (None, None), (900, None), (901, ""), (902, "x" * 50_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(plain_terms(rows), key=repr)
    assert found_terms(df) == want
    actions = {s[2] for _, spans in want for s in spans}
    assert actions == {"remove", "generalise"}


def test_terms_planted_in_the_documents(spark):
    """Among the given documents: the planted name goes, all others stay without terms."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    planted = [(10**9 + k, f"{'lorem ipsum dolor sit amet '[k:]} Quirinius {k} wrote " + "and so on " * 40 + f"from qq@corp.com number {k}") for k in range(20)]
    planted.append((10**9 + 50, "only Quirinius is named"))
    out = sanitise.find_personal(docs.union(spark.createDataFrame(planted, docs.schema)))
    shown = {r.doc_id: [r.text[s.begin : s.finish] for s in r.personal.term] for r in out.where("size(personal.term) > 0").collect()}
    assert set(shown) == {p[0] for p in planted}
    assert all("Quirinius" in found for found in shown.values())


def test_many_finds_in_one_text(spark):
    """Time grows with the finds, not with their square."""
    df = spark.createDataFrame([(0, "a@b.c 1.2.3.4 " * 16_000)], "doc_id long, text string")
    begin = time.time()
    (row,) = sanitise.personal_report(df).select("n_email", "n_ip", "base_sha256").collect()
    assert (row.n_email, row.n_ip) == (16_000, 16_000) and time.time() - begin < 60


def test_running_totals(spark):
    for n in (0, 1, 63, 64, 65, 128, 1000):
        got = spark.range(1).select(F.expr(f"slice(sequence(0, {n}), 2, {n})").alias("x")).select(sanitise.running(F.col("x").cast("array<int>"), F.lit(0), lambda x, y: x + y).alias("s")).first().s
        assert got == [k * (k + 1) // 2 for k in range(n)]


def test_copies_are_no_evidence(spark):
    rows = [(k, "Waldemar wrote from jw@corp.com") for k in range(12)] + [(100 + k, "other words") for k in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert all(not r.personal.term for r in sanitise.find_personal(df).collect())


def test_near_copies_are_one_text(spark):
    """Edited copies of a text with an address tell nothing, however many; texts that differ do."""
    rnd = random.Random(8)
    base = [f"rare{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(120)]
    rows = []
    for k in range(40):
        words = list(base)
        words[rnd.randint(0, 119)] = f"edit{chr(97 + k % 26)}"
        words.insert(60 + rnd.randint(-4, 4), "copied@corp.com")
        rows.append((k, " ".join(words)))
    for k in range(40, 400):
        rows.append((k, " ".join(rnd.choice(["lorem", "ipsum", "dolor", "amet", "sed"]) + rnd.choice(["um", "is", "or"]) for _ in range(30))))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    same = sanitise.same_texts(df.selectExpr("doc_id AS doc_key", "text")).collect()
    assert len({r.same for r in same if r.doc_key < 40}) == 1 and len({r.same for r in same}) == 361
    assert all(not spans for _, spans in found_terms(df))
    other = spark.createDataFrame([(1000 + k, rows[100 + k][1] + f" Quirinius {rows[200 + k][1]} copied@corp.com") for k in range(6)], df.schema)
    found = dict(found_terms(df.union(other)))
    assert all(len(found[1000 + k]) == 1 for k in range(6)) and all(not found[k] for k in range(400))


def test_chance_is_no_evidence(spark):
    """Rare words in texts of an address that a third of all texts name."""
    rows = [(k, f"{chr(97 + k % 26) * 3}{chr(97 + k // 26) * 2} common words of text {k % 7} here" + (" all@corp.com" if k % 3 == 0 else "") + (f" rare{'abcdefgh'[k // 9 % 8]}" if k % 9 == 0 and k < 216 else "")) for k in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(plain_terms(rows), key=repr)
    assert found_terms(df) == want and not any(spans for _, spans in want)


def test_sanitised(spark):
    rows = crowd() + [(500, None), (501, ""), (502, "call +1 (555) 123-4567 or 4111 1111 1111 1111"), (100, crowd()[12][1]), (503, "clean text stays"), (504, "😀é 1.2.3.4 " * 700 + "x" * 3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "length(text) AS n_chars", "'p' AS personal")
    out = sanitise.sanitised(df)
    assert out.columns == df.columns and out.count() == len(rows)
    text = {r.doc_id: r for r in out.collect()}
    assert text[500].text is None and text[501].text == "" and text[503].text == "clean text stays"
    assert text[504].text == "😀é <ip> " * 700 + "x" * 3000
    assert text[502].text == "call <phone> or <card>"
    assert "<email>" in text[0].text and "Waldemar" not in text[0].text
    assert text[100].text == crowd()[12][1]
    assert all(r.n_chars == len(r.text) for r in text.values() if r.text is not None)
    assert sanitise.sanitised(df.limit(0)).collect() == []


def test_no_join_lies_below_the_count_of_words(spark, monkeypatch):
    """Every word of every text is counted before it meets the candidate terms."""
    plans, store = [], sanitise.C.checkpointed

    def noted(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return store(df)

    monkeypatch.setattr(sanitise.C, "checkpointed", noted)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    # Without an entity of several contexts no words are counted.
    sanitise.personal_report(docs.union(spark.createDataFrame(crowd(), docs.schema)))
    (counts,) = [p for p in plans if "n_t#" in p and "disclosure" not in p]
    assert "Join" not in counts and "Aggregate" in counts
