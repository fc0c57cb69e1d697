"""Secret scan: candidates by pattern, false positives removed by a random forest.

Candidates are tokens that mix letters and digits, long numbers, tokens of an
issuer's format with or without digits, passwords inside URLs, values assigned
to a name such as ``password`` (or ``password_value``), and private key blocks. The forest judges each
by its length and characters, its character transitions against the corpus,
dictionary coverage, its path, and the words around it. It is trained from
labelled findings: a table of the caller's, or the ones ``corpus_findings``
labels by strict formats, with counter-examples made of the same findings. All documents and all findings are
learned from: text is counted by Spark, and the trees grow a level a round from histograms of fixed bins.

Defined cases: a null or empty text has no candidates; repeated rows give
repeated findings; an issuer's key on word bounds is cut out of a longer run or
named value, whose rest stands alone; of other overlapping candidates the longest stays; with no
labelled findings nothing is called a secret; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from .common import broadcast_value, map_batches, spilled, written

#: Common letter 4-grams kept as the dictionary.
GRAMS = 6000
#: Different words a task counts before it hands them on, and findings a task lays into histograms at once.
WORDS_HELD = 1 << 18
ROWS_HELD = 1 << 17
#: Trees of the forest, bins of a measure, and (a bound of) open nodes of a tree.
TREES = 40
BINS = 128
MOST_NODES = 1 << 10
THRESHOLD = 0.5
#: Characters on either side that count as the neighbourhood.
AROUND = 48

# Names that go before a secret, words that speak against one, and strict formats of issuers.
SECRET_NAMES = r"passw(?:or)?d|passwd|pwd|token|secret|api[_-]?key|access[_-]?key|auth|credentials?|private[_-]?key"
SECRET_NAMES_PLAIN = ("password", "passwd", "pwd", "token", "secret", "api_key", "access_key", "auth", "credential", "private_key")
DOUBTS = ("example", "sample", "dummy", "fake", "placeholder", "test", "changeme", "your", "xxxx", "todo", "redacted")
#: Values that stand for a secret without being one.
PLACEHOLDERS = ("changeme", "your_password", "<password>", "${PASSWORD}", "{{ secret }}", "%s", "example", "dummy", "placeholder",
                "none", "null", "true", "false", "string", "required", "********", "xxxx", "[redacted]")
OTHER_NAMES = ("sha", "md5", "commit", "hash", "digest", "checksum", "uuid", "guid", "revision", "version", "mail", "phone",
               "order", "card", "iban", "isbn", "build", "etag")
DOUBTFUL_PATHS = ("test", "example", "sample", "fixture", "doc", "readme", "lock", "vendor", "mock")
ISSUED = {
    "aws_access_key": re.compile(r"(?:AKIA|ASIA)[0-9A-Z]{16}"),
    "github_token": re.compile(r"gh[pousr]_[A-Za-z0-9]{36,}"),
    "slack_token": re.compile(r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    "google_key": re.compile(r"AIza[0-9A-Za-z_-]{35}"),
    "stripe_key": re.compile(r"[rs]k_(?:live|test)_[0-9A-Za-z]{16,}"),
    "jwt": re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]*"),
}

_DIGITS = re.compile(r"[0-9]+")
_RUN = re.compile(r"[A-Za-z0-9+/_.~-]+={0,2}")
#: What may follow a secret's name before the value is assigned.
_SUFFIX = r"(?:[_-]?(?:id|value|val|key|string|str|base64|b64|env|prod|dev|live|test|old|new|[0-9]{1,3}))?"
_NAMED = re.compile(rf"({SECRET_NAMES}){_SUFFIX}[\"']?\s{{0,3}}(?:=>|:=|[:=])\s{{0,3}}[\"'`]?([^\s\"'`,;]{{4,}})", re.I)
_BLOCK = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----.*?(?:-----END [A-Z ]*PRIVATE KEY-----|\Z)", re.S)
_NAME_BEFORE = re.compile(rf"(?:{SECRET_NAMES}){_SUFFIX}[\"']?\s{{0,3}}(?:=>|:=|[:=])?\s{{0,3}}[\"'`]?$", re.I)
#: Beginnings of the formats in ISSUED; a text without any of them is not searched for the formats.
_ISSUED_MARKS = ("AKIA", "ASIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "xox", "AIza", "k_live_", "k_test_", "eyJ")
_USER_INFO = re.compile(r"://[^\s/?#:@\"'<>]*:([^\s/?#\"'<>]+)@")
_WORD = re.compile(r"[^\W\d_]{3,}")
_IN_RUN = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.~-=")


_PLACEHOLDER = re.compile(r"[<\[{(%$].*|(.)\1*|none|null|nil|true|false|string|str|required|optional|undefined|(?:os\.|process\.)?"
                          rf"(?:get)?env\b.*|(?:{SECRET_NAMES})", re.I | re.S)


def placeholder(value: str) -> bool:
    """Whether the value clearly stands for a secret without being one."""
    low = value.strip(".,;:!?").lower()
    return any(d in low for d in DOUBTS) or bool(_PLACEHOLDER.fullmatch(low))


def _without(text: str, span: tuple[int, int, str], issued: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """The span, or what the issuers' keys inside it (sorted, each on word bounds) leave of it."""
    a, b, kind = span
    if kind in ("url_password", "private_key"):
        return [span]
    inside = [s for s in issued[bisect_left(issued, (a,)):bisect_left(issued, (b,))] if s[1] <= b and s[:2] != (a, b)]
    if not inside:
        return [span]
    out = []
    for start, end in zip([a, *(s[1] for s in inside)], [*(s[0] for s in inside), b]):
        value = text[start:end].strip("._-/+=&?)")
        mixed = len(value) >= 8 and any(map(str.isalpha, value)) and any(map(str.isdigit, value))
        if mixed or kind == "named_value" and len(value) >= 4 or value.isdigit() and len(value) >= 12:
            at = text.index(value, start)
            out.append((at, at + len(value), "named_value" if kind == "named_value" else "token" if mixed else "number"))
    return out


def candidates(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of every candidate of the whole text, in order, none overlapping."""
    spans: list[tuple[int, int, str]] = []
    done = 0
    for m in _DIGITS.finditer(text):
        if m.start() < done:
            continue
        a, b = m.span()
        while a > done and text[a - 1] in _IN_RUN:
            a -= 1
        run = _RUN.match(text, m.start())
        b = done = max(run.end() if run else b, b)
        first = text.rfind("=", a, m.start()) + 1  # name=value
        a = max(a, first)
        value = text[a:b].strip("._-/+")
        a = text.index(value, a) if value else a
        b = a + len(value)
        mixed = len(value) >= 8 and any(map(str.isalpha, value))
        if mixed or len(value) >= 12:
            kind = next((k for k, p in ISSUED.items() if p.search(value)), "token" if mixed else "number")
            spans.append((a, b, kind))
    if "://" in text:
        spans += [(*m.span(1), "url_password") for m in _USER_INFO.finditer(text)]
    if "=" in text or ":" in text:
        spans += [(*m.span(2), "named_value") for m in _NAMED.finditer(text)]
    if "PRIVATE KEY-----" in text:
        spans += [(*m.span(), "private_key") for m in _BLOCK.finditer(text)]
    if any(mark in text for mark in _ISSUED_MARKS):
        issued = [(*m.span(), kind) for kind, p in ISSUED.items() for m in p.finditer(text)]
        whole = sorted(s for s in issued if not text[max(0, s[0] - 1):s[0]].isalnum() and not text[s[1]:s[1] + 1].isalnum())
        spans = [rest for s in spans for rest in _without(text, s, whole)] + issued
    spans.sort(key=lambda s: (s[0], -s[1], s[2] in ("token", "number"), s[2] == "named_value"))
    out: list[tuple[int, int, str]] = []
    for s in spans:
        if out and s[0] < out[-1][1]:
            if s[1] - s[0] > out[-1][1] - out[-1][0]:
                out[-1] = s
        else:
            out.append(s)
    return out


@dataclass(frozen=True)
class Corpus:
    """What ordinary text looks like: log-probabilities of character pairs, and common letter 4-grams."""

    pairs: np.ndarray  # 128 x 128
    grams: frozenset[str]


def _ascii(s: str) -> np.ndarray:
    return np.frombuffer(s.encode("ascii", "replace"), np.uint8) & 127


def measures(corpus: Corpus, value: str, before: str, after: str, path: str) -> list[float]:
    n = max(1, len(value))
    codes = _ascii(value)
    count = Counter(value)
    entropy = -sum(c / n * math.log2(c / n) for c in count.values())
    kind = np.array([0 if c.isdigit() else 1 if c.islower() else 2 if c.isupper() else 3 for c in value] or [3])
    turns = float((kind[1:] != kind[:-1]).mean()) if n > 1 else 0.0
    usual = float(corpus.pairs[codes[:-1], codes[1:]].mean()) if n > 1 else 0.0
    low = value.lower()
    known = np.zeros(n, bool)
    for i in range(n - 3):
        if low[i:i + 4] in corpus.grams:
            known[i:i + 4] = True
    around, close = (before + " " + after).lower(), before.lower()
    last_words = close.split()[-3:]
    folder = path.lower()
    return [math.log(n), float((kind == 0).mean()), float((kind == 1).mean()), float((kind == 2).mean()),
            float((kind == 3).mean()), entropy, len(count) / n, turns, usual, float(known.mean()),
            float(all(c in "0123456789abcdefABCDEF" for c in value)), float(value.isdigit()),
            float(any(p.fullmatch(value) for p in ISSUED.values())), float(bool(_NAME_BEFORE.search(before))),
            float(any(re.search(SECRET_NAMES, w) for w in last_words)), float(before[-1:] in ("\"", "'", "`", "=")),
            float(any(d in low for d in DOUBTS)), float(any(d in around for d in DOUBTS)),
            float(any(o in w for w in last_words for o in OTHER_NAMES)), float("@" in before[-1:] + after[:1]),
            float("://" in before[-30:]), float(any(p in folder for p in DOUBTFUL_PATHS)), float(after[:1].isalnum()), float(placeholder(value))]


@dataclass(frozen=True)
class Forest:
    """Trees as arrays: feature (-1 at a leaf), cut, child to the left (right is next), share of secrets."""

    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]

    def probability(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x))
        rows = np.arange(len(x))
        for feature, cut, left, share in self.trees:
            node = np.zeros(len(x), np.int64)
            while True:
                inner = feature[node] >= 0
                if not inner.any():
                    break
                go = np.where(x[rows, feature[node]] <= cut[node], left[node], left[node] + 1)
                node = np.where(inner, go, node)
            out += share[node]
        return out / max(1, len(self.trees))


def _cuts() -> list[np.ndarray]:
    """Between the bins of each measure: fixed values, at most ``BINS`` - 1 a measure, that no data decides."""
    lengths = np.log(np.concatenate([np.arange(1, 81) + 0.5, np.geomspace(82, 1e5, BINS - 81)]))
    share, flag = (np.arange(BINS - 1) + 0.5) / (BINS - 1), np.array([0.5])
    spread, usual = np.linspace(0, 8, BINS + 1)[1:-1], np.linspace(-20, 0, BINS + 1)[1:-1]
    return [lengths, *[share] * 4, spread, share, share, usual, share, *[flag] * 14]


CUTS = _cuts()


def _binned(x: np.ndarray) -> np.ndarray:
    return np.stack([np.searchsorted(c, x[:, j]) for j, c in enumerate(CUTS)], axis=1).astype(np.uint8)


def _drawn(marks: np.ndarray, tree: int) -> np.ndarray:
    """How often a tree's bootstrap draws each row: Poisson(1) from a hash of the row and the tree, the same at any layout."""
    z = marks + np.uint64((tree + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    u = (z >> np.uint64(11)).astype(np.float64) / (1 << 53)
    return np.searchsorted(np.cumsum([math.exp(-1) / math.factorial(k) for k in range(9)]), u, side="right")


class _Growing:
    """A tree while it grows: as in ``Forest``, with the bin up to which rows go left, and the open nodes' measures."""

    def __init__(self):
        self.feature, self.cut, self.left, self.share = [-1], [0], [0], [0.5]
        self.open: list[int] = [0]
        self.tried: list[np.ndarray] = []

    def arrays(self) -> tuple[np.ndarray, ...]:
        slot = np.full(len(self.feature), -1)
        slot[self.open] = np.arange(len(self.open))
        return np.array(self.feature), np.array(self.cut), np.array(self.left), slot, np.array(self.tried)


def _cells(tree: int, grown: tuple[np.ndarray, ...], ones: np.ndarray, x: np.ndarray, marks: np.ndarray) -> pa.RecordBatch:
    """(node, feature, bin, n, ones) of the rows drawn for the tree that stand in an open node."""
    feature, cut, left, slot, tried = grown
    times = _drawn(marks, tree)
    drawn = np.flatnonzero(times)
    node = np.zeros(len(drawn), np.int64)
    moving = np.arange(len(drawn)) if feature[0] >= 0 else np.arange(0)
    while len(moving):
        at = node[moving]
        node[moving] = left[at] + (x[drawn[moving], feature[at]] > cut[at])
        moving = moving[feature[node[moving]] >= 0]
    inside = slot[node] >= 0
    rows, place = drawn[inside], slot[node[inside]]
    which = tried[place]  # rows x measures tried
    key = ((place[:, None] * len(CUTS) + which) * BINS + x[rows[:, None], which]) * 2 + ones[rows][:, None]
    got = np.bincount(key.ravel(), np.repeat(times[rows], which.shape[1]), len(slot[slot >= 0]) * len(CUTS) * BINS * 2).astype(np.int64)
    got = got.reshape(-1, 2)
    full = np.flatnonzero(got.sum(axis=1))
    part, bins = np.divmod(full, BINS)
    cols = (tree * MOST_NODES + part // len(CUTS), part % len(CUTS), bins, got[full].sum(axis=1), got[full, 1])
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["node", "feature", "bin", "n", "ones"])


def _best_splits(blocks: DataFrame, trees: list[_Growing], least: int) -> dict[int, Row]:
    """The best split of each open node over all rows of ``blocks`` (ones, x, marks); counted, cumulated and compared by Spark."""
    shared = broadcast_value(blocks.sparkSession, {t: g.arrays() for t, g in enumerate(trees) if g.open})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted(held: list[tuple[bytes, bytes, bytes]]) -> Iterator[pa.RecordBatch]:
            ones, x, marks = (np.frombuffer(b"".join(c), t) for c, t in zip(zip(*held), (np.uint8, np.uint8, np.uint64)))
            for tree, grown in shared.value.items():
                yield _cells(tree, grown, ones, x.reshape(len(ones), len(CUTS)), marks)

        held, n = [], 0
        for b in batches:
            for block in zip(*(c.to_pylist() for c in b.columns)):
                held.append(block)
                n += len(block[0])
                if n >= ROWS_HELD:
                    yield from counted(held)
                    held, n = [], 0
        if held:
            yield from counted(held)

    cells = (map_batches(blocks.select("ones", "x", "marks"), run, "node long, feature long, bin long, n long, ones long")
             .groupBy("node", "feature", "bin").agg(F.sum("n").alias("n"), F.sum("ones").alias("ones")))
    part = Window.partitionBy("node", "feature")  # at most BINS rows
    upto = part.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    cells = cells.select("node", "feature", "bin", F.lead("bin").over(part.orderBy("bin")).alias("next"), F.sum("n").over(upto).alias("nl"),
                         F.sum("ones").over(upto).alias("ol"), F.sum("n").over(part).alias("n"), F.sum("ones").over(part).alias("ones"))
    nr, impure = F.col("n") - F.col("nl"), lambda ones, n: ones * (n - ones) / n  # n times the Gini impurity, halved
    gain = (impure(F.col("ones"), F.col("n")) - impure(F.col("ol"), F.col("nl")) - impure(F.col("ones") - F.col("ol"), nr)) / F.col("n")
    fit = F.col("next").isNotNull() & (F.col("nl") >= least) & (nr >= least)
    split = F.when(fit, F.struct(gain.alias("gain"), (-F.col("feature")).alias("feature"), (-F.col("bin")).alias("bin"), "next", "nl", "ol"))
    best = cells.groupBy("node").agg(F.max(split).alias("s"), F.max("n").alias("n"), F.max("ones").alias("ones"))
    return {r["node"]: r for r in best.collect()}  # one row per open node


def grow_forest(blocks: DataFrame, trees: int = TREES, depth: int = 8, least: int = 2, seed: int = 11) -> Forest:
    """Bagged Gini trees over all rows of ``blocks``, a level a round; each split looks at a random third of the measures.

    Every row has its place in the histograms (tree, node, measure, bin) of the trees that draw it. The driver sees one
    row per open node.
    """
    rng = np.random.default_rng(seed)
    some = max(1, len(CUTS) // 3)
    grown = [_Growing() for _ in range(trees)]
    for level in range(depth):
        for g in grown:
            g.tried = [rng.choice(len(CUTS), some, replace=False) for _ in g.open]
        if not any(g.open for g in grown):
            break
        best = _best_splits(blocks, grown, least)
        for t, g in enumerate(grown):
            was, g.open = g.open, []
            for slot, k in enumerate(was):
                if not (r := best.get(t * MOST_NODES + slot)):
                    continue
                g.share[k] = r["ones"] / r["n"]
                if not (s := r["s"]) or s["gain"] <= 1e-12:
                    continue
                # between two bins that hold rows, the cut goes half-way
                g.feature[k], g.cut[k], g.left[k] = -s["feature"], (s["next"] - s["bin"] - 1) // 2, len(g.feature)
                for n, ones in ((s["nl"], s["ol"]), (r["n"] - s["nl"], r["ones"] - s["ol"])):
                    if 0 < ones < n and n >= 2 * least:
                        g.open.append(len(g.feature))
                    g.feature.append(-1)
                    g.cut.append(0)
                    g.left.append(0)
                    g.share.append(ones / n)
    return Forest([(np.array(g.feature), np.array([CUTS[f][c] if f >= 0 else 0.0 for f, c in zip(g.feature, g.cut)]),
                    np.array(g.left), np.array(g.share)) for g in grown])


@dataclass(frozen=True)
class Model:
    corpus: Corpus
    forest: Forest | None


def learn_corpus(docs: DataFrame, text_col: str = "text") -> Corpus:
    """Character pairs and common 4-grams of the words of all documents, counted by Spark."""

    def counted(pairs: np.ndarray, words: Counter) -> pa.RecordBatch | None:
        grams: Counter = Counter()
        for w, n in words.items():
            for i in range(len(w) - 3):
                grams[w[i:i + 4]] += n
        rows = [("", int(i), int(pairs[i])) for i in np.flatnonzero(pairs)] + [(g, -1, n) for g, n in grams.items()]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["g", "p", "n"]) if rows else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, words = np.zeros((128, 128), np.int64), Counter()
        for b in batches:
            own = [dict.fromkeys(_WORD.findall((text or "").lower())) for text in b.column(0).to_pylist()]
            for some in own:
                words.update(some.keys())
            codes = _ascii("\0".join(map(" ".join, own))).astype(np.int64)  # no pair goes from text to text
            pairs += np.bincount(codes[:-1] * 128 + codes[1:], minlength=1 << 14).reshape(128, 128)
            pairs[0], pairs[:, 0] = 0, 0
            if len(words) > WORDS_HELD:
                yield counted(pairs.ravel(), words)
                pairs, words = np.zeros((128, 128), np.int64), Counter()
        if (rest := counted(pairs.ravel(), words)) is not None:
            yield rest

    partial = map_batches(docs.select(F.col(text_col).cast("string")), run, "g string, p long, n long")
    counted_once = spilled(partial.groupBy("g", "p").agg(F.sum("n").alias("n")))
    pairs = np.ones((128, 128))
    # at most 128 x 128 rows, and GRAMS rows
    for r in counted_once.where("p >= 0").collect():
        pairs[r["p"] // 128, r["p"] % 128] += r["n"]
    grams = counted_once.where("p < 0").orderBy(F.desc("n"), "g").limit(GRAMS).collect()
    counted_once.unpersist()
    return Corpus(np.log(pairs / pairs.sum(axis=1, keepdims=True)), frozenset(r["g"] for r in grams))


def _random_looking(value: str) -> bool:
    return len(value) >= 12 and sum(map(str.isdigit, value)) >= 2 and len(set(value)) >= 7


def _in_url(before: str, after: str) -> bool:
    return "://" in before and after[:1] == "@"


def _labelled(value: str, before: str, after: str, where: str, label: int, fixed: bool, words: list[str]) -> list[tuple]:
    """The finding, and its counter-examples if it is a secret."""
    rows = [(value, before, after, where, label)]
    if label:
        turn = zlib.crc32(value.encode("utf-8", "replace"))
        named, in_url = bool(_NAME_BEFORE.search(before)), _in_url(before, after)
        rows += [("x" * len(value), before, after, where, 0), (value[:4] + "EXAMPLE" + value[4:], before, after, where, 0)]
        if named or in_url:  # an ordinary word may be a password here
            rows.append((PLACEHOLDERS[turn % len(PLACEHOLDERS)], before, after, where, 0))
        else:
            rows.append((words[turn % len(words)], before, after, where, 0))
        if not fixed and not in_url:
            other = re.sub(SECRET_NAMES, OTHER_NAMES[turn % len(OTHER_NAMES)], before, flags=re.I)
            rows += [(value, other, after, where, 0), (value, after[-8:] + " ", after, where, 0)]
    return rows


def _in_path(key: str, before: str, after: str, where: str, digest: str) -> tuple[str, str, str, str, int, bool]:
    """The key as it stands, or, one time in four, as a part of a path."""
    if int(digest[14], 16) % 4 == 0:
        before, after = (before + f"https://files.host.org/{digest[15]}/")[-AROUND:], f"/{digest[16]}" + after
    return key, before, after, where, 1, True


def _planted(text: str, where: str) -> tuple[str, str, str, str, int, bool]:
    """A secret made of the text's digest, set in the middle of the text."""
    digest = hashlib.sha256(text.encode("utf-8", "replace")).hexdigest()
    letters = "".join(chr(ord("A") + int(digest[i:i + 2], 16) % 26) if i % 3 else digest[i] for i in range(0, 60, 2))
    middle = text.find(" ", len(text) // 2) + 1
    before, after = text[max(0, middle - AROUND):middle], " " + text[middle:middle + AROUND]
    name = SECRET_NAMES_PLAIN[int(digest[:4], 16) % len(SECRET_NAMES_PLAIN)]
    form = int(digest[-2:], 16) % 6
    if form == 0:
        key = letters.upper()[:16]
        if int(digest[12], 16) % 4 == 0:  # some keys hold no digit
            key = re.sub("[0-9]", lambda m: chr(ord("A") + int(m[0])), key)
        return _in_path("AKIA" + key, before, after, where, digest)
    if form == 1:
        return _in_path("ghp_" + (letters + digest)[:36], before, after, where, digest)
    value = (digest[:18], digest[:32], digest[:40], (letters[:10] + digest)[:24])[form - 2]
    lead = (f"{name}=", f"{name}: ", f'{name} = "', f"{name} := '")[int(digest[8:10], 16) % 4]
    return value, (before + lead)[-AROUND:], lead[-1].strip(" =") + after, where, 1, False


def _everyday(text: str, where: str, words: list[str]) -> tuple[str, str, str, str, int, bool]:
    """A password as people choose them, made of the text's words and digest, assigned to a name or inside a URL."""
    digest = hashlib.sha256(text.encode("utf-8", "replace")).hexdigest()
    n = [int(digest[i:i + 4], 16) for i in range(0, 64, 4)]
    middle = text.find(" ", len(text) // 2) + 1
    before, after = text[max(0, middle - AROUND):middle], " " + text[middle:middle + AROUND]
    one, two, three = (words[n[i] % len(words)][:12].lower() for i in (0, 1, 2))
    mark, year = "!@#$%&*?"[n[3] % 8], str(1950 + n[4] % 90)
    value = (one.capitalize() + year + mark, one.capitalize() + two.capitalize() + three.capitalize(), one + str(n[5] % 1000),
             one + two, digest[:6 + n[6] % 6], "".join(chr(97 + int(c, 16) + n[7] % 10) for c in digest[20:28 + n[8] % 8]),
             one.capitalize() + two.capitalize(), mark.join((one, two, year)))[n[9] % 8]
    if n[10] % 4 == 0:
        lead = f"{('postgres', 'https', 'redis', 'amqp')[n[11] % 4]}://{two}:"
        return value.replace("#", "!").replace("?", "!"), (before + lead)[-AROUND:], f"@{three}.host/{one}" + after, where, 1, False
    name = SECRET_NAMES_PLAIN[n[12] % len(SECRET_NAMES_PLAIN)] + ("", "", "", "_value", "_id")[n[13] % 5]
    lead = (f"{name}=", f"{name}: ", f'{name} = "', f"{name} := '")[n[14] % 4]
    return value, (before + lead)[-AROUND:], lead[-1].strip(" =") + after, where, 1, False


def corpus_findings(docs: DataFrame, text_col: str = "text", path: Column | None = None) -> DataFrame:
    """Labelled findings (value, before, after, path, label) of the given documents.

    A candidate is labelled 1 if it has an issuer's format, stands as the password inside a URL, or is assigned to a
    secret's name and looks random. Named values that neither look random nor are clear placeholders are left out: what
    they are isn't known. Others are 0. One text in four also gets a secret made of its digest set between two of its
    words, so that every format is learned whatever the corpus holds, and another one in four a short or letter-only
    password. Of each finding labelled 1, counter-examples labelled 0 are made: a placeholder in its place (an ordinary
    word too, where no secret's name stands before), and the same value under the name of a digest or an id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text, where in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                text = text or ""
                words = _WORD.findall(text) or ["word"]
                for a, e, kind in candidates(text):
                    value, before, after = text[a:e], text[max(0, a - AROUND):a], text[e:e + AROUND]
                    fixed = kind in ISSUED or kind == "private_key"
                    named = kind == "named_value" or bool(_NAME_BEFORE.search(before))
                    label = int(not (placeholder(value) if named or kind == "url_password" else any(d in value.lower() for d in DOUBTS))
                                and (fixed or kind == "url_password" or named and _random_looking(value)))
                    if named and not label and not fixed and not placeholder(value):
                        continue
                    rows += _labelled(value, before, after, where, label, fixed, words)
                turn = zlib.crc32(text.encode("utf-8", "replace")) % 4
                if text and turn == 0:
                    rows += _labelled(*_planted(text, where), words)
                if text and turn == 1:
                    rows += _labelled(*_everyday(text, where, words), words)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)],
                                                 names=["value", "before", "after", "path", "label"])

    where = F.coalesce(path.cast("string"), F.lit("")) if path is not None else F.lit("")
    return map_batches(docs.select(F.col(text_col).cast("string"), where), run,
                       "value string, before string, after string, path string, label long")


def train(docs: DataFrame, findings: DataFrame | None = None, text_col: str = "text", path: Column | None = None) -> Model:
    """Fit the forest on all labelled findings; by default on those of all documents."""
    corpus = learn_corpus(docs, text_col)
    found = findings if findings is not None else corpus_findings(docs, text_col, path)
    shared = broadcast_value(docs.sparkSession, corpus)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(v or "", p or "", a or "", w or "", y) for v, p, a, w, y in zip(*(c.to_pylist() for c in b.columns))]
            if not rows:
                continue
            x = _binned(np.array([measures(shared.value, *r[:4]) for r in rows]))
            ones = np.array([r[4] for r in rows], np.uint8)
            marks = b"".join(hashlib.blake2b(repr(r).encode("utf-8", "replace"), digest_size=8).digest() for r in rows)
            yield pa.RecordBatch.from_arrays([pa.array([c]) for c in (len(rows), int(ones.sum()), ones.tobytes(), x.tobytes(), marks)],
                                             names=["n", "n_ones", "ones", "x", "marks"])

    src = found.select("value", "before", "after", "path", F.col("label").cast("long"))
    # read once a level: under 40 bytes a finding
    blocks = written(map_batches(src, run, "n long, n_ones long, ones binary, x binary, marks binary"))
    n, ones = blocks.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("n_ones"), F.lit(0))).first()
    if not 0 < ones < n:
        return Model(corpus, None)
    return Model(corpus, grow_forest(blocks))


def judged(model: Model, text: str, path: str) -> list[tuple[int, int, str, float]]:
    """Candidates of a whole text with the forest's probability."""
    spans = candidates(text)
    if not spans:
        return []
    x = np.array([measures(model.corpus, text[a:b], text[max(0, a - AROUND):a], text[b:b + AROUND], path) for a, b, _ in spans])
    p = model.forest.probability(x) if model.forest else np.zeros(len(x))
    return [(a, b, kind, float(q)) for (a, b, kind), q in zip(spans, p)]


def scan(docs: DataFrame, model: Model, id_cols: list[str], text_col: str = "text", path: Column | None = None,
         threshold: float = THRESHOLD) -> DataFrame:
    """One row per candidate: ``id_cols``, start, end, kind, value, probability and is_secret."""
    shared = broadcast_value(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, paths = b.column(b.num_columns - 2).to_pylist(), b.column(b.num_columns - 1).to_pylist()
            rows, of = [], []
            for i, (text, where) in enumerate(zip(texts, paths)):
                for a, e, kind, p in judged(shared.value, text or "", where or ""):
                    rows.append((a, e, kind, text[a:e], p, p >= threshold))
                    of.append(i)
            if rows:
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [*(c.take(pa.array(of)) for c in b.columns[:-2]), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                     *(pa.array(c) for c in cols[2:])],
                    names=[*b.schema.names[:-2], "start", "end", "kind", "value", "probability", "is_secret"])

    where = path.cast("string") if path is not None else F.lit("")
    src = docs.select(*[F.col(c) for c in id_cols], F.col(text_col).cast("string").alias("__text"), where.alias("__path"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-2])
    return map_batches(src, run, f"{fields}, start long, end long, kind string, value string, probability double, "
                                 "is_secret boolean")


def redact(docs: DataFrame, model: Model, text_col: str = "text", path: Column | None = None,
           threshold: float = THRESHOLD) -> DataFrame:
    """All rows and columns of ``docs``, with every secret of the text replaced by ``[SECRET:kind]``."""
    shared = broadcast_value(docs.sparkSession, model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, paths = b.column(at).to_pylist(), b.column(b.num_columns - 1).to_pylist()
            for i, text in enumerate(texts):
                found = [s for s in judged(shared.value, text or "", paths[i] or "") if s[3] >= threshold]
                for a, e, kind, _ in reversed(found):
                    text = f"{text[:a]}[SECRET:{kind}]{text[e:]}"
                texts[i] = text
            cols = list(b.columns[:-1])
            cols[at] = pa.array(texts, cols[at].type)
            yield pa.RecordBatch.from_arrays(cols, names=b.schema.names[:-1])

    where = path.cast("string") if path is not None else F.lit("")
    # positions, not names, tell the columns apart, so the helper column clashes with none
    names = [f"c{i}" for i in range(len(docs.columns))]
    src = docs.select("*", where.alias("p")).toDF(*names, "p")
    kept = map_batches(src, run, ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema.fields)))
    return kept.toDF(*docs.columns)
