"""Language identification by compression: the language whose dictionary compresses a text best.

Each language gets a raw-content dictionary for zstandard: letters of learning documents (a bounded sample: per language
the ``samples`` documents with the smallest hash, ``slice_chars`` from a place of each chosen by that hash, at most
``dictionary_bytes``). A text is reduced to its letters in lower case, cut into chunks that a dictionary can help, and
every chunk of the whole text is compressed with every dictionary. The smallest sum wins. The prediction is ``rejected``
where the next language is within ``margin``; the label is given all the same.

Null texts and texts without a letter are ``und`` (score 0, rejected). Ties go to the language with more learning
documents, then by name. Repeated rows get the same answer. With no learning document everything is ``und``. Other columns are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowjudge.llm.common import text_of

_NOT_LETTER = re.compile(r"[\W\d_]+")


@dataclass(frozen=True)
class LanguageConfig:
    samples: int = 400
    slice_chars: int = 400
    dictionary_bytes: int = 112 << 10
    chunk: int = 4096
    margin: float = 0.01
    salts: int = 32


def letters(text: str) -> str:
    return _NOT_LETTER.sub(" ", text.lower()).strip()


def dictionaries(docs: DataFrame, cfg: LanguageConfig = LanguageConfig()) -> list[tuple[str, bytes]]:
    """(language, dictionary), languages with more learning documents first, from ``docs`` (text, lang). A dictionary is a bounded
    sample: slices of ``slice_chars``, one of each of up to ``samples`` texts, in the order of their hashes until it is full."""
    known = docs.where("lang IS NOT NULL AND text IS NOT NULL").select(
        F.col("lang").cast("string").alias("lang"), "text", F.xxhash64("text").alias("h"))
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    # the first of each salt of a language, then the first of those: no task gets a whole language
    cut = F.substring("text", (F.pmod("h", F.greatest(F.length("text") - cfg.slice_chars, F.lit(1))) + 1).cast("int"), F.lit(cfg.slice_chars))
    parts = known.select("lang", "h", cut.alias("part")).where("part RLIKE '\\\\p{L}'")
    salted = parts.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang", F.pmod("h", F.lit(cfg.salts))).orderBy("h", "part"))).where(F.col("rank") <= cfg.samples)
    top = salted.dropDuplicates(["lang", "h"]).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("h", "part")))
    rows = top.where(F.col("rank") <= cfg.samples).select("lang", "rank", "part").collect()  # languages x samples slices
    out, full = {}, set()
    for r in sorted(rows, key=lambda r: (r["lang"], r["rank"])):
        more = out.get(r["lang"], b"") + letters(r["part"]).encode() + b" "
        if r["lang"] in full or len(more) > cfg.dictionary_bytes and r["lang"] in out:
            full.add(r["lang"])
            continue
        out[r["lang"]] = more
    order = sorted(out, key=lambda name: (-counts[name], name))
    return [(name, out[name]) for name in order]


def _compressor(dictionary: bytes):
    content = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    params = zstandard.ZstdCompressionParameters.from_level(
        6, window_log=17, min_match=3, write_content_size=0, write_dict_id=0, write_checksum=0)
    content.precompute_compress(compression_params=params)
    return zstandard.ZstdCompressor(dict_data=content, compression_params=params)


def predict(docs: DataFrame, known: list[tuple[str, bytes]], cfg: LanguageConfig = LanguageConfig()) -> DataFrame:
    """The columns of ``docs`` other than text and any that are named like a result, then lang_pred, score and rejected."""
    names = [name for name, _ in known]
    keep = [c for c in docs.columns if c.lower() not in ("text", "lang_pred", "score", "rejected")]

    def run(batches):
        packers = [_compressor(d) for _, d in known]
        for batch in batches:
            lang, score, rejected = [], [], []
            for text in batch.column(len(keep)).to_pylist():
                own = letters(text or "")
                if not own or not packers:
                    lang.append("und"), score.append(0.0), rejected.append(True)
                    continue
                data = own.encode()
                sizes = np.zeros(len(packers))
                for at in range(0, len(data), cfg.chunk):
                    piece = data[at: at + cfg.chunk]
                    sizes += [len(p.compress(piece)) for p in packers]
                best = int(sizes.argmin())
                chance = np.exp(-100 * (sizes / sizes[best] - 1))
                others = np.delete(sizes, best)
                lang.append(names[best])
                score.append(float(chance[best] / chance.sum()))
                rejected.append(bool(len(others) and others.min() < sizes[best] * (1 + cfg.margin)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(len(keep))] +
                [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
                names=keep + ["lang_pred", "score", "rejected"])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name in keep] +
                       ["lang_pred string, score double, rejected boolean"])
    return docs.select(*[f"`{c}`" for c in keep], text_of().alias("text")).mapInArrow(run, schema)
