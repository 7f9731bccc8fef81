"""Language identification by compression with one dictionary per language."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shortfall.llm.base import crc_mod, sample_texts

OTHER = re.compile(r"[\W\d_]+")
UNDETERMINED = "und"
RESULT = "lang_pred string, score double, margin double, rejected boolean"


def letters(text: str) -> bytes:
    """Lower-cased words of letters with one space between them."""
    return OTHER.sub(" ", text.lower()).strip().encode()


@dataclass
class LanguageModel:
    """Raw-content dictionaries by language.

    A text is cut into blocks, each block is encoded against every
    dictionary, and the language with the smallest sum is chosen. Blocks keep
    the dictionary, not the text's own past, the main source of matches.
    """

    contents: dict[str, bytes]
    block: int = 1024
    min_margin: float = 0.004
    _coders: dict = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "_coders": {}}

    def coders(self) -> dict:
        if not self._coders:
            made = {}
            for lang in sorted(self.contents):
                params = zstandard.ZstdCompressionParameters.from_level(
                    5, window_log=18, min_match=3, strategy=zstandard.STRATEGY_BTOPT,
                    write_content_size=False, write_dict_id=False, write_checksum=False,
                )
                data = zstandard.ZstdCompressionDict(
                    self.contents[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT
                )
                data.precompute_compress(compression_params=params)
                made[lang] = zstandard.ZstdCompressor(dict_data=data, compression_params=params)
            self._coders = made
        return self._coders

    def sizes(self, plain: bytes) -> dict[str, int]:
        """Encoded bytes by language."""
        blocks = [plain[i : i + self.block] for i in range(0, len(plain), self.block)]
        return {lang: sum(len(coder.compress(b)) for b in blocks) for lang, coder in self.coders().items()}

    def predict(self, text: str | None) -> tuple[str, float, float, bool]:
        plain = letters(text) if text is not None else b""
        if not plain or not self.contents or not any(c.isalpha() for c in plain.decode()):
            return UNDETERMINED, 0.0, 0.0, True
        ranked = sorted((size, lang) for lang, size in self.sizes(plain).items())
        best, lang = ranked[0]
        if len(ranked) == 1:
            return lang, 1.0, 1.0, False
        gap = np.array([best - size for size, _ in ranked], float)
        score = float(1.0 / np.exp(gap * 0.5).sum())
        margin = (ranked[1][0] - best) / ranked[1][0]
        return lang, score, float(margin), bool(margin < self.min_margin)


def train(
    docs: DataFrame,
    training: Column,
    per_language: int = 150,
    dictionary_bytes: int = 192_000,
    per_text: int = 128_000,
) -> LanguageModel:
    """Dictionaries from a bounded sample of labelled rows.

    The bound is ``per_language`` different texts, of each at most
    ``per_text`` characters, and ``dictionary_bytes`` of normalised text for
    each language. Rows with a null id are learned from like others; a repeated
    text counts once.
    """
    sample = sample_texts(docs.filter(training), "lang", per_language, per_text)
    contents: dict[str, bytes] = {}
    for row in sorted(sample.collect(), key=lambda r: (r.lang, r.text)):
        so_far = contents.get(row.lang, b"")
        contents[row.lang] = (so_far + b" " + letters(row.text)[:per_text]).strip()[:dictionary_bytes]
    contents = {lang: content for lang, content in contents.items() if len(content) >= 8}
    return LanguageModel(contents)


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` with a struct column ``_language``: prediction, score, margin, rejected.

    Null, empty or letterless texts are ``und``, score 0, rejected. Very long
    texts are read whole, block by block. Equal sizes go to the language that
    sorts first and are rejected. Other columns of ``docs`` stay as they are;
    each row gets its own result, repeated rows the same one; an empty table
    gives an empty result. Without a labelled row every text is ``und``.
    """

    @F.pandas_udf(RESULT)
    def predict(texts: pd.Series) -> pd.DataFrame:
        rows = [model.predict(t) for t in texts]
        return pd.DataFrame(rows, columns=["lang_pred", "score", "margin", "rejected"])

    return docs.withColumn("_language", predict(F.col("text")))


def language_id(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, held_out, lang_pred, score, margin, rejected) of the documents.

    Learns from rows with a language whose crc32(doc_id) mod 3 is not 1.
    """
    docs = docs.select("doc_id", "text", "lang")
    held_out = crc_mod(F.col("doc_id"), 3) == 1
    model = train(docs, ~held_out)
    return identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "_language.*"
    )
