"""Language identification by compression (operator 6).

A text is compressed once per language with zstandard, each time with that
language's raw-content dictionary; the language with the fewest bytes wins and
a narrow margin is rejected. Long texts are compressed in chunks, so that the
dictionary, not the text's own repetitions, decides; the whole text is used.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import unit_hash

UNDETERMINED = "und"


@dataclass(frozen=True)
class LangSpec:
    """The dictionaries are fitted on a bounded sample: about ``sample_docs`` texts per language,
    ``excerpt_chars`` characters each, ``dict_bytes`` bytes in all. A text is rejected when the
    runner-up needs under ``min_margin`` (a share) more bytes. ``softness`` (bytes) scales the score."""

    dict_bytes: int = 110_000
    sample_docs: int = 200
    excerpt_chars: int = 4_000
    level: int = 5
    chunk: int = 1_000
    min_margin: float = 0.003
    softness: float = 4.0
    seed: int = 6


def train_dictionaries(labelled: DataFrame, spec: LangSpec = LangSpec()) -> dict[str, bytes]:
    """Raw dictionary content per language of ``labelled`` (columns text, lang), most frequent language first."""
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    held = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    order = sorted(held, key=lambda x: (-held[x], x))
    if not order:
        return {}
    rate = F.element_at(F.create_map(*[F.lit(v) for k in order for v in (k, min(1.0, spec.sample_docs / held[k]))]), F.col("lang"))
    drawn = (
        rows.where(unit_hash(F.col("text"), F.lit(spec.seed)) < rate)
        .select("lang", F.substring("text", 1, spec.excerpt_chars).alias("text"))
        .distinct()
        .collect()
    )
    out = {}
    for lang in order:
        parts = sorted(r["text"].lower().encode() for r in drawn if r["lang"] == lang)
        out[lang] = b"\n".join(parts)[: spec.dict_bytes]
    return out


def _compressors(dictionaries: dict[str, bytes], level: int) -> dict[str, zstandard.ZstdCompressor]:
    out = {}
    for lang, content in dictionaries.items():
        d = None
        if len(content) >= 8:
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
        out[lang] = zstandard.ZstdCompressor(level=level, dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False)
    return out


def compressed_sizes(text: str, compressors: dict[str, zstandard.ZstdCompressor], chunk: int) -> dict[str, int]:
    """Bytes of the whole text under each language's dictionary."""
    raw = text.lower().encode("utf-8", "replace")
    pieces = [raw[i : i + chunk] for i in range(0, len(raw), chunk)]
    return {lang: sum(len(c.compress(p)) for p in pieces) for lang, c in compressors.items()}


def classify(text: str | None, compressors: dict[str, zstandard.ZstdCompressor], spec: LangSpec) -> tuple[str, float, bool]:
    """(language, score, rejected); ties go to the language listed first, the most frequent one."""
    if not compressors or text is None or not any(map(str.isalpha, text)):
        return UNDETERMINED, 0.0, True
    sizes = compressed_sizes(text, compressors, spec.chunk)
    best = min(sizes, key=sizes.__getitem__)
    others = [s - sizes[best] for lang, s in sizes.items() if lang != best]
    score = 1.0 / (1.0 + sum(math.exp(-x / spec.softness) for x in others))
    margin = min(others, default=sizes[best]) / max(1, sizes[best])
    return best, score, margin < spec.min_margin


def identify_language(df: DataFrame, dictionaries: dict[str, bytes], spec: LangSpec = LangSpec()) -> DataFrame:
    """All columns of ``df`` plus ``lang_pred``, ``score`` (0 to 1) and ``rejected``.

    Only ``text`` is looked at. A null text or one without letters is
    ``und`` with score 0, rejected; without any dictionary all texts are.
    Input columns with the three names are replaced.
    """

    @F.arrow_udf("lang_pred string, score double, rejected boolean")
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        compressors = _compressors(dictionaries, spec.level)
        for texts in batches:
            rows = list(zip(*(classify(t.as_py(), compressors, spec) for t in texts))) or [()] * 3
            columns = [pa.array(list(c), k) for c, k in zip(rows, (pa.string(), pa.float64(), pa.bool_()))]
            yield pa.StructArray.from_arrays(columns, names=["lang_pred", "score", "rejected"])

    keep = [c for c in df.columns if c not in ("lang_pred", "score", "rejected")]
    judged = df.select(*[F.col(f"`{c}`") for c in keep], judge(F.col("text")).alias("__gd_lang"))
    return judged.select(*[F.col(f"`{c}`") for c in keep], *[F.col(f"__gd_lang.{c}").alias(c) for c in ("lang_pred", "score", "rejected")])
