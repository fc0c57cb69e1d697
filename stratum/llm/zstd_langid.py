"""Language identification by compression.

Per language a raw-content zstandard dictionary is cut from labelled text.
A document is cut into blocks, every block is compressed with every
dictionary, and the language whose dictionary gives the fewest bytes in all
wins. The margin between the two best languages decides the score and the
rejection. Blocks keep long texts from adapting to themselves, and let the
whole text count.

Defined cases: a null text, or one without any letter, is ``und`` with score 0
and rejected; ties go to the language with more training text, then by name (and are
rejected); repeated rows give repeated results; with no labelled text every
document is ``und``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard as zstd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_value, map_batches

UNDETERMINED = "und"
#: Dictionaries per language, and bytes of each: what is learned, collected and broadcast per language.
SHARDS = 3
DICT_BYTES = 64_000
#: Letters of a block. Texts of at most SHORT letters are compressed with every dictionary of a language.
BLOCK = 800
SHORT = 300
LEVEL = 6
MIN_MATCH = 4
#: Goes before each block, so that a few words don't end up as a stored, uncompressed block.
PAD = b" " * 64
#: A document is rejected when the runner-up needs less than this share of bytes more.
MARGIN = 0.002

_NOT_LETTERS = re.compile(r"[\W\d_]+")


def letters_only(text: str) -> str:
    """Lower-case words, one space between, a run of one word once: case, junk and drumming say nothing about language."""
    words = _NOT_LETTERS.sub(" ", text.lower()).split()
    return " ".join(w for w, before in zip(words, [None, *words]) if w != before)


def train_dictionaries(docs: DataFrame, learn: Column, text_col: str = "text", lang_col: str = "lang",
                       dict_bytes: int = SHARDS * DICT_BYTES) -> dict[str, bytes]:
    """Raw dictionary content by language from the rows where ``learn`` holds.

    Lines are drawn from all those rows by a hash of the line, at a share that
    follows from the bytes of each language, so a few times ``dict_bytes`` per
    language reach the driver however large the input is.
    """
    rows = docs.where(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("n")).collect()}
    share = F.lit(0)
    for lang, n in sizes.items():
        share = F.when(F.col("lang") == lang, F.lit(min(10**9, int(3e9 * dict_bytes / max(1, n)) + 1))).otherwise(share)
    lines = rows.select("lang", F.explode(F.split("text", "\n")).alias("line"))
    order = F.xxhash64("line")
    sample = (lines.where((F.length("line") > 0) & (F.pmod(order, F.lit(10**9)) < share))
              .select("lang", order.alias("h"), "line").distinct().collect())
    out: dict[str, bytes] = {}
    for lang in sorted(sizes, key=lambda k: (-(sizes[k] or 0), k)):  # the order in which ties are won
        text = " ".join(letters_only(r["line"]) for r in sorted((r for r in sample if r["lang"] == lang),
                                                                key=lambda r: (r["h"], r["line"])))
        if text.strip():
            out[lang] = text.encode()[:dict_bytes]
    return out


def _compressor(content: bytes) -> zstd.ZstdCompressor:
    d = zstd.ZstdCompressionDict(content, dict_type=zstd.DICT_TYPE_RAWCONTENT)
    params = zstd.ZstdCompressionParameters.from_level(
        LEVEL, dict_size=len(content), min_match=MIN_MATCH, write_content_size=False, write_checksum=False,
        write_dict_id=False)
    d.precompute_compress(compression_params=params)
    return zstd.ZstdCompressor(dict_data=d, compression_params=params)


class _Classifier:
    def __init__(self, dictionaries: dict[str, bytes]):
        self.langs = list(dictionaries)
        parts = [[d[i:i + DICT_BYTES] for i in range(0, len(d), DICT_BYTES)] for d in map(dictionaries.get, self.langs)]
        # every language gets as many dictionaries, so that sums of sizes compare
        least = min(map(len, parts), default=0)
        self.compressors = [[_compressor(x) for x in p[:least]] for p in parts]

    def sizes(self, letters: str) -> list[int]:
        """Bytes that the whole text takes with each language's dictionaries."""
        blocks = [PAD + letters[i:i + BLOCK].encode("utf-8", "replace") for i in range(0, len(letters), BLOCK)]
        use = None if len(letters) <= SHORT else 1
        return [sum(len(c.compress(b)) for c in own[:use] for b in blocks) for own in self.compressors]

    def __call__(self, text: str | None, margin: float) -> tuple[str, float, float, bool]:
        if not text or not self.langs or not any(map(str.isalpha, text)):
            return UNDETERMINED, 0.0, 0.0, True
        sizes = self.sizes(letters_only(text))
        order = sorted(range(len(sizes)), key=lambda i: (sizes[i], i))
        best = order[0]
        if len(order) == 1:
            return self.langs[best], 1.0, 1.0, False
        gap = sizes[order[1]] / max(1, sizes[best]) - 1.0
        return self.langs[best], math.tanh(gap / 0.04), gap, gap < margin


def identify(docs: DataFrame, dictionaries: dict[str, bytes], id_cols: list[str], text_col: str = "text",
             margin: float = MARGIN) -> DataFrame:
    """``id_cols`` plus lang_pred, score (0 to 1), margin and rejected, one row per row of ``docs``.

    The broadcast is ``DICT_BYTES`` per learned language.
    """
    shared = broadcast_value(docs.sparkSession, dictionaries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classify = _Classifier(shared.value)
        for b in batches:
            got = [classify(t, margin) for t in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64()),
                 pa.array([g[2] for g in got], pa.float64()), pa.array([g[3] for g in got], pa.bool_())],
                names=[*b.schema.names[:-1], "lang_pred", "score", "margin", "rejected"])

    keys = [F.col(c) for c in id_cols]
    src = docs.select(*keys, F.col(text_col).cast("string").alias("__text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1])
    return map_batches(src, run, f"{fields}, lang_pred string, score double, margin double, rejected boolean")


def keep_identified(docs: DataFrame, dictionaries: dict[str, bytes], text_col: str = "text",
                    margin: float = MARGIN) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is told; those rejected go."""
    shared = broadcast_value(docs.sparkSession, dictionaries)
    at, names = docs.columns.index(text_col), [f"c{i}" for i in range(len(docs.columns))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classify = _Classifier(shared.value)
        for b in batches:
            yield b.filter(pa.array([not classify(t, margin)[3] for t in b.column(at).to_pylist()], pa.bool_()))

    schema = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, docs.schema.fields))
    return map_batches(docs.toDF(*names), run, schema).toDF(*docs.columns)
