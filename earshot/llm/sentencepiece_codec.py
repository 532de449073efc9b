"""SentencePiece encoding and decoding through a distinct-chunk table.

No piece of the model has a whitespace marker behind another character, so
merges never cross the point where a run of markers begins. A text (with its
dummy marker) is therefore a sequence of chunks, each a run of markers and the
characters up to the next run, that are segmented independently. Each task keeps
a table of the distinct chunks it has met, segments a chunk once with the
library, and joins ids back by position. The table holds at most
``table_chunks`` entries and is emptied when full, so memory stays bounded.

The table lives in the task, not in a shuffle: joining every occurrence of every
word back by key would move several times the input.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.llm.common import map_rows, table

MODEL = "piece_bpe_32k.model"
TABLE_CHUNKS = 500_000
#: Longer chunks are segmented without being kept.
LONGEST_KEPT = 256
_CHUNK = re.compile(r" +[^ ]*")


def chunks(text: str) -> list[str]:
    """A text with the dummy marker, cut before every run of markers. The marker
    sign itself counts as a space, as the library reads it."""
    text = text.replace("▁", " ")
    if "  " not in text and text[:1] != " " and text[-1:] != " ":
        return [" " + w for w in text.split(" ")] if text else []
    return _CHUNK.findall(" " + text)


def has_pieces_across_markers(processor) -> bool:
    """Whether a piece holds a marker behind another character, so that chunks can't be segmented on their own."""
    pieces = (processor.id_to_piece(i) for i in range(processor.get_piece_size()) if not (processor.is_control(i) or processor.is_unknown(i) or processor.is_byte(i)))
    return any("▁" in piece.lstrip("▁") for piece in pieces)


class ChunkTable(dict):
    """chunk -> (ids, ids as text, decoded chunk with its markers)."""

    def __init__(self, processor, limit: int):
        super().__init__()
        self.processor, self.limit = processor, limit

    def __missing__(self, chunk: str) -> tuple:
        ids = self.processor.encode(chunk[1:]) if len(chunk) > 1 else self.processor.encode("")
        if not ids:  # a lone marker: the library returns nothing for an empty text
            ids = [self.processor.piece_to_id("▁")]
        # the leading piece loses its dummy marker in decode(), the chunk keeps it
        entry = (ids, ",".join(map(str, ids)), " " + self.processor.decode(ids))
        if len(chunk) <= LONGEST_KEPT:
            if len(self) >= self.limit:
                self.clear()
            self[chunk] = entry
        return entry


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", digests: bool = False, table_chunks: int = TABLE_CHUNKS) -> DataFrame:
    """doc_id, n_tokens and ids (array<int>) per row; with ``digests`` instead of
    ids: ids_sha256 and decoded_sha256.

    A model with pieces across markers is used on whole texts instead of chunks.
    Null and empty texts have no ids. Repeated rows are encoded each; null ids
    pass through; no rows give no rows; other columns are not read.
    """
    fields = "ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_file=model_path)
        held = ChunkTable(processor, table_chunks)
        whole = has_pieces_across_markers(processor)
        for batch in batches:
            rows = []
            for text in batch["text"]:
                if whole:
                    ids = processor.encode(text)
                    found = [(ids, ",".join(map(str, ids)), " " + processor.decode(ids))] if ids else []
                else:
                    found = [held[c] for c in chunks(text)]
                n = sum(len(e[0]) for e in found)
                if digests:
                    rows.append((n, _sha256(",".join([e[1] for e in found])), _sha256("".join([e[2] for e in found])[1:])))
                else:
                    rows.append((n, [i for e in found for i in e[0]]))
            names = ["n_tokens", "ids_sha256", "decoded_sha256"] if digests else ["n_tokens", "ids"]
            out = pd.DataFrame(rows, columns=names)
            out.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield out

    slim = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return map_rows(slim, "doc_id", run, f"n_tokens long, {fields}")


def decode(encoded: DataFrame, model_path: str, ids_col: str = "ids") -> DataFrame:
    """Adds ``decoded``: the library's decode(ids) of each row; null ids give ''."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_file=model_path)
        for ids in batches:
            yield ids.map(lambda x: "" if x is None or not len(x) else processor.decode([int(i) for i in x]))

    return encoded.withColumn("decoded", F.pandas_udf(run, "string")(F.col(ids_col)))


def default_model() -> str:
    """The model's path; ``encode`` takes any other."""
    import public_tokenizers

    return public_tokenizers.path(MODEL)


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents", "doc_id", "text"), default_model(), digests=True)
