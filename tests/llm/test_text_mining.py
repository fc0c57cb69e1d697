"""op11 to op13: against brute force over whole small tables, on edge cases, and on planted cases."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from stratum.llm import bootstrap_pii as pii
from stratum.llm import queries, spelling_variants, trie_phrases

SF = "/root/testdata/sf0.001"
A_TO_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
CLASH = "id string, word string, n long, part int, path string, `row` string, strict string, found string, marks string, ids string, f long"


def _docs(spark, texts, lang="en"):
    rows = [(i, t, lang if i % 2 else None) + (None,) * 11 for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, {CLASH}").repartition(3)


# --- op11 ---------------------------------------------------------------------------------------

def _brute_variants(words, ratio=10):
    """word -> (form, root, n, n_near, form_n), by all pairs through deletions and replacements."""
    alphabet = sorted(set("".join(words)))

    def near(w):
        out = {w[:i] + w[i + 1:] for i in range(len(w))}
        out |= {w[:i] + c + w[i + j:] for j in (0, 1) for i in range(len(w) + 1 - j) for c in alphabet}
        return [x for x in out if x != w and x in words]

    form, count = {}, {}
    for w, n in words.items():
        those = near(w)
        best = min(those, key=lambda x: (-words[x], x), default=None)
        form[w], count[w] = best if best and words[best] >= ratio * n else None, len(those)

    def root(w):
        return root(form[w]) if form[w] else w

    return {w: (form[w], root(w), n, count[w], words[form[w]] if form[w] else None) for w, n in words.items()}


def _variants(df):
    rows = df.collect()
    out = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    assert len(out) == len(rows)
    return out


def test_variants_query_equals_brute_force(spark):
    counted = Counter()
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", r["text"] or ""):
            run = run.translate(A_TO_Z)
            h = zlib.crc32(f"{r['doc_id']}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counted[run] += 1
    words = {w: n for w, n in counted.items() if len(w) >= 7 and n >= 2}
    assert _variants(queries.op11_spelling_variants(spark, SF)) == _brute_variants(words)


@pytest.mark.parametrize("seed", range(3))
def test_variants_of_dense_random_words(spark, seed):
    """Words over two letters, so all of them are near others, at several numbers of ranges and chains of forms."""
    rng = random.Random(seed)
    words = {"".join(rng.choice("aé") for _ in range(rng.randint(1, 7))): 10 ** rng.randint(0, 5) for _ in range(90)}
    words |= {"x" * 3000: 5, "x" * 2999: 500, "x" * 2998: 50_000}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    spark.conf.set("spark.sql.shuffle.partitions", str(3 + 7 * seed))
    try:
        got = _variants(spelling_variants.group_variants(df))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    expected = _brute_variants({w: n for w, n in words.items() if len(w) < 100})
    assert {w: v for w, v in got.items() if len(w) < 100} == expected
    assert got["x" * 3000] == ("x" * 2999, "x" * 2998, 5, 1, 500) and got["x" * 2999][3] == 2


def test_variants_edges(spark):
    texts = [None, "", " ", "abcdefg ABCDEFG", "abcdefg", "abcdefgh", "abcdefgh", "Ünïcodé漢ÿÿÿÿÿÿÿ", "ÿÿÿÿÿÿÿ", "a" * 50_000, "a" * 50_000]
    docs = _docs(spark, texts + texts[4:5])
    words = spelling_variants.count_words(docs)
    assert {(r["word"][:9], r["n"]) for r in words.collect()} == {("abcdefg", 4), ("abcdefgh", 2), ("ÿ" * 7, 2), ("a" * 9, 2)}
    got = _variants(spelling_variants.group_variants(words, ratio=2))
    assert got["abcdefgh"] == ("abcdefg", "abcdefg", 2, 1, 4) and got["abcdefg"] == (None, "abcdefg", 4, 1, None)
    assert spelling_variants.group_variants(spelling_variants.count_words(docs.where("doc_id < 0"))).count() == 0


# --- op12 ---------------------------------------------------------------------------------------

def _brute_phrases(docs, least, top=2000, scale=2_000_000, covered=80):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in docs:
        for piece in re.split("[.,;:!?\x0A-\x0D]", (text or "").translate(A_TO_Z)):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang or "und"] += len(words)
            for k in range(1, 5):
                counts[lang or "und"].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        cand = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        rows = []
        for g, a in cand.items():
            if any(100 * b >= covered * a and len(o) > len(g) and any(o[i:i + len(g)] == g for i in range(len(o)))
                   for o, b in cand.items()):
                continue
            score, _, l, r = min((scale * a // (f[g[:k]] + f[g[k:]]), k, f[g[:k]], f[g[k:]]) for k in range(1, len(g)))
            rows.append((-score, -a, " ".join(g).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def _phrases(df):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


@pytest.mark.parametrize("words, phrases", [(1 << 20, 1 << 19), (7, 5)])
def test_phrases_equal_brute_force(spark, monkeypatch, words, phrases):
    """Also with blocks so small that words and candidates come in many."""
    rng = random.Random(1)
    vocabulary = ["The", "of", "É", "a b", "new", "York", "漢", "x\x1cy", "to"]
    texts = ["".join(rng.choice(vocabulary) + rng.choice([" ", " ", "  ", "\t", ". ", "\n", ",", " ; "]) for _ in range(rng.randint(0, 60)))
             for _ in range(60)] + [None, "", "...", "new york " * 200]
    docs = _docs(spark, texts)
    monkeypatch.setattr(trie_phrases, "WORDS", words)
    monkeypatch.setattr(trie_phrases, "PHRASES", phrases)
    got = _phrases(trie_phrases.collocations(docs, least=6, top=50))
    assert got == _brute_phrases([(r["lang"], r["text"]) for r in docs.collect()], 6, 50) and len(got) > 40


@pytest.mark.parametrize("bits", [5, 24])
def test_phrases_are_counted_in_one_pass_whatever_the_counters_let_through(spark, monkeypatch, bits):
    """Also with so few counters that all reach the least count; what is broadcast are words and counters, no candidates."""
    rng = random.Random(4)
    docs = _docs(spark, [" ".join(rng.choice("abcdefghijkl") + rng.choice(["", "", "."]) for _ in range(rng.randint(0, 80))) for _ in range(120)])
    sent = []
    broadcast = trie_phrases.broadcast_value
    monkeypatch.setattr(trie_phrases, "broadcast_value", lambda spark, value: sent.append(value) or broadcast(spark, value))
    monkeypatch.setattr(trie_phrases, "PHRASES", 20)
    monkeypatch.setattr(trie_phrases, "SKETCH_BITS", bits)
    monkeypatch.setattr(trie_phrases, "MOST_BITS", bits, raising=False)
    monkeypatch.setattr(trie_phrases, "_PART", 16 if bits == 5 else 1 << 16)
    got = _phrases(trie_phrases.collocations(docs, least=6, top=100))
    assert got == _brute_phrases([(r["lang"], r["text"]) for r in docs.collect()], 6, 100) and len(got) > 80
    assert len(sent) == 2


def test_counters_grow_with_the_corpus(spark, monkeypatch):
    asked = []
    sketch = trie_phrases._sketch
    monkeypatch.setattr(trie_phrases, "_sketch", lambda encoded, least, bits: asked.append(bits) or sketch(encoded, least, 24))
    encoded = spark.createDataFrame([(bytearray(b"\xff" * 4),)], "ids binary")
    for words in (10 ** 6, 10 ** 9, 10 ** 11):
        assert trie_phrases.count_phrases(encoded, 30, words).columns == ["w1", "w2", "w3", "w4", "f"]
    assert asked == [24, 26, 28]


def test_trie_counts_all_phrases():
    import numpy as np

    rng = np.random.default_rng(3)
    ids = rng.integers(-1, 300, 40_000).astype(np.int32)
    ids[::7] = 299  # a hot word
    rows = {tuple(ids[i:i + k]) + (-1,) * (4 - k) for i in range(len(ids) - 4) for k in (2, 3, 4) if (ids[i:i + k] >= 0).all()}
    rows = np.array(sorted(rows), np.int32)
    trie = trie_phrases.Trie(rows)
    padded = np.concatenate([ids, np.full(4, -1, np.int32)])
    expected = Counter(tuple(padded[i:i + k]) + (-1,) * (4 - k) for i in range(len(ids)) for k in (2, 3, 4) if (padded[i:i + k] >= 0).all())
    known = set(map(tuple, rows.tolist()))
    assert {tuple(p): n for p, n in zip(trie.phrases.tolist(), trie.count(padded)) if n} == {p: n for p, n in expected.items() if p in known}


def test_phrases_edges(spark):
    empty = _docs(spark, ["a b"]).where("doc_id < 0")
    assert trie_phrases.collocations(empty).count() == 0
    assert trie_phrases.collocations(_docs(spark, [None, "", "one two"])).count() == 0
    long = trie_phrases.collocations(_docs(spark, ["again and again. " * 40_000])).collect()
    assert [(r["lang"], r["phrase"], r["a"], r["n"]) for r in long] == [("und", "again and again", 40_000, 120_000)]


# --- op13 ---------------------------------------------------------------------------------------

_NAIVE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _brute_base(text):
    out = []
    for kind, (name, pattern) in enumerate(_NAIVE.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub(r"\D", "", m[0])
            if name == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if name == "card":
                weighed = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
                if not 14 <= len(digits) <= 19 or sum(x // 10 + x % 10 for x in weighed) % 10:
                    continue
            if name == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_strict_spans_equal_plain_expressions():
    rng = random.Random(5)
    for _ in range(4000):
        text = "".join(rng.choice(["1", "25", "0", ".", ".", "@", "a", "-", "+", " ", "(", "é", "_", "x.y", "4111111111111111", "+1 (303) 555-01"])
                       for _ in range(rng.randint(0, 30)))
        assert pii.strict_spans(text) == _brute_base(text), text
    assert pii.strict_spans("9" * 300_000 + "a" * 300_000 + "@") == []


def test_personal_data_query_keeps_base_spans(spark):
    got = {r["doc_id"]: r for r in queries.op13_personal_data(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(docs)
    seen = 0
    for d in docs:
        r, base = got[d["doc_id"]], _brute_base(d["text"])
        told = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert r["base_sha256"] == hashlib.sha256(told.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(k == i for _, k, _ in base) for i in range(4)]
        assert r["n_found"] or r["spans"] == told
        seen += len(base)
    assert seen > 5


def _number(rng, n):
    return "".join(rng.choice("0123456789") for _ in range(n))


def test_patterns_discover_unseen_identifiers(spark):
    rng = random.Random(2)
    texts = [f"Notes.\nYou can phone me at +44 {_number(rng, 10)} today" for _ in range(20)]
    texts += [f"Contact: ann{i}@mail{i}.example.org or so" for i in range(20)]
    hidden = ["You can phone me at 0301 {} today".format(_number(rng, 6)), "Contact: bob [at] example [dot] org or so",
              "Contact: jörg@exämple or so"]
    # the same forms elsewhere, and in places where identifiers of all kinds stand
    clean = ["Order 0301 445566 was sent out", "bob [at] example [dot] org", "sold 12345678 of them in the year"]
    mixed = [f"the code of {x} was" for i in range(12) for x in (f"a{i}@b.org", f"+44 {_number(rng, 10)}", f"10.0.0.{i}", _number(rng, 9))]
    docs = _docs(spark, texts + hidden + clean + mixed)
    got = {r["row"]["doc_id"]: r for r in pii.extract(docs).collect()}
    for i, text in enumerate(texts + hidden + clean + mixed):
        found = [(s["kind"], text[s["start"]:s["end"]]) for s in got[i]["found"]]
        if 40 <= i < 43:
            assert found == [[(pii.PHONE, hidden[0][20:31])], [(pii.EMAIL, "bob [at] example [dot] org")], [(pii.EMAIL, "jörg@exämple")]][i - 40]
        else:
            assert found == []
    clean_texts = {r["doc_id"]: r["text"] for r in pii.redact(docs).collect()}
    assert clean_texts[40] == "You can phone me at [PHONE] today" and clean_texts[20] == "Contact: [EMAIL] or so" and clean_texts[43] == clean[0]


def test_second_round_learns_from_the_first(spark):
    """Numbers found by a first pattern vouch for a second one that no seed stands in."""
    rng = random.Random(4)
    local = [f"0{_number(rng, 8)}" for _ in range(14)]
    texts = [f"please ring us on +49 {_number(rng, 9)} now" for _ in range(90)] + [f"please ring us on {n} now" for n in local]
    texts += [f"my mobile number is {n} thanks" for n in local] + ["my mobile number is 055512345 thanks"]
    docs = _docs(spark, texts)
    one = {r["row"]["doc_id"]: r["found"] for r in pii.extract(docs, rounds=1).collect()}
    two = {r["row"]["doc_id"]: r["found"] for r in pii.extract(docs).collect()}
    assert all(one[i] for i in range(90, 104)) and not one[118]
    assert all(two[i] for i in range(90, 119)) and [s["start"] for s in two[118]] == [20]


def test_personal_data_edges(spark):
    texts = [None, "", "a@b.c", "a@b.c", "no data at all", "+1 (303) 555-0123 " * 20_000, "x" * 200_000 + "@y.z"]
    got = {r["row"]["doc_id"]: r for r in pii.extract(_docs(spark, texts), ["doc_id", "row", "found"]).collect()}
    assert [len(got[i]["strict"]) for i in range(7)] == [0, 0, 1, 1, 0, 20_000, 1] and got[2]["row"]["found"] is None
    twice = _docs(spark, texts[2:3]).unionByName(_docs(spark, texts[2:3]))
    assert pii.extract(twice).count() == 2 and pii.extract(twice.where("doc_id < 0")).count() == 0
    assert pii.redact(twice).columns == twice.columns and pii.redact(_docs(spark, [None])).first()["text"] is None
    assert pii.extract(twice).select(pii.spelled(F.col("strict")).alias("s")).first()["s"] == "email:0:5"


# --- op10 ---------------------------------------------------------------------------------------

def test_nearness_equals_all_pairs_and_stays_linear():
    import time

    from stratum.llm import boosted_toxicity as bt

    rng = random.Random(6)
    for _ in range(300):
        a, b = (sorted(rng.sample(range(200), rng.randint(0, 12))) for _ in range(2))
        assert bt._near(a, b) == sum(any(abs(x - y) <= bt.NEAR for y in b) for x in a)
    began = time.time()
    assert bt._near(list(range(0, 2_000_000, 2)), list(range(1, 2_000_000, 2))) == 1_000_000 and time.time() - began < 5
