"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives a single-pass Viterbi.

The automaton reads a text once. At each position its output links name the pieces that end there, and each relaxes the
best score of that position from the best score where the piece began. Characters that no piece covers become bytes.
Where the vocabulary shows that no piece reaches over a cut, as between a word and the blank behind it, the search runs on
the stretches between one by one; each distinct stretch is searched once per task while it stays in a bounded cache.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

#: Where the public vocabulary lies; a parameter, never copied into the repository.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Below the worst piece by so much is what a character without a piece costs.
UNKNOWN_PENALTY = 10.0
#: Distinct stretches kept per task, and the longest stretch that is kept.
CACHE, CACHED_LENGTH = 400_000, 64
MARK = "▁"
LOWEST = float("-inf")
LATIN = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]"


@dataclass
class PieceModel:
    """Ordinary pieces with ids and scores, ids of the 256 byte pieces, and all pieces' bytes by id. Blanks stand for marks."""

    scores: dict[str, tuple[int, float]]
    byte_ids: list[int]
    surface: list[bytes]
    stretch: str = field(init=False)
    unknown: float = field(init=False)

    def __post_init__(self) -> None:
        def none_has(pattern: str) -> bool:
            return not any(re.search(pattern, p) for p in self.scores)

        # cuts that no piece reaches over: before a blank, at a line break, and between Latin letters and other signs
        other = LATIN.replace("[", "[^ \n")
        if not none_has(r"[^ ] |\n.|.\n"):
            self.stretch = r"(?s).+"
        elif none_has(f"{LATIN}{other}|{other}{LATIN}"):
            self.stretch = f" *(?:{LATIN}+|{other}+)|\n| +"
        else:
            self.stretch = r" *[^ \n]+|\n| +"
        self.unknown = min((s for _, s in self.scores.values()), default=0.0) - UNKNOWN_PENALTY

    @classmethod
    def load(cls, path: str = MODEL) -> PieceModel:
        """Read a SentencePiece model with byte fallback; the file is read on the driver only."""
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=path)
        scores, byte_ids, surface = {}, [0] * 256, []
        for i in range(m.get_piece_size()):
            piece = m.id_to_piece(i)
            surface.append(piece.replace(MARK, " ").encode())
            if m.is_byte(i):
                byte_ids[int(piece[3:5], 16)], surface[i] = i, bytes([int(piece[3:5], 16)])
            elif m.is_control(i) or m.is_unknown(i) or m.is_unused(i):
                surface[i] = b""
            else:
                scores[piece.replace(MARK, " ")] = (i, m.get_score(i))
        return cls(scores, byte_ids, surface)


class Encoder:
    """The automaton of one model with a cache of encoded stretches."""

    def __init__(self, model: PieceModel) -> None:
        import ahocorasick

        self.model, self.cache, self.split = model, {}, re.compile(model.stretch).findall
        self.automaton = ahocorasick.Automaton()
        for piece, (i, score) in model.scores.items():
            self.automaton.add_word(piece, (len(piece), i, score))
        self.automaton.make_automaton()
        self.single = {p for p in model.scores if len(p) == 1}

    def viterbi(self, text: str) -> tuple[int, ...]:
        """Ids of the best-scored segmentation; among equal scores the longest last piece wins, at every position."""
        n = len(text)
        best, back = [0.0] + [LOWEST] * n, [None] * (n + 1)
        known, closed = self.single.issuperset(text), 0
        for end, piece in self.automaton.iter(text):
            if not known and closed < end:
                self._skip_unknown(text, closed, end, best, back)
                closed = end
            end += 1
            score = best[end - piece[0]] + piece[2]
            if score > best[end]:
                best[end], back[end] = score, piece
        if not known:
            self._skip_unknown(text, closed, n, best, back)
        out: list[int] = []
        while n:
            length, i, _ = back[n]
            if i >= 0:
                out.append(i)
            else:
                out.extend(self.model.byte_ids[b] for b in reversed(text[n - 1].encode()))
            n -= length
        return tuple(reversed(out))

    def _skip_unknown(self, text: str, start: int, end: int, best: list[float], back: list) -> None:
        """Step over characters without a piece of their own, at their cost."""
        for at in range(start, end):
            if text[at] not in self.single and best[at] + self.model.unknown > best[at + 1]:
                best[at + 1], back[at + 1] = best[at] + self.model.unknown, (1, -1, 0.0)

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text, which is read with one blank before it; an empty text has none."""
        ids: list[int] = []
        if not text:
            return ids
        cache, extend = self.cache, ids.extend
        for part in self.split(" " + text):
            found = cache.get(part)
            if found is None:
                found = self.viterbi(part)
                if len(part) <= CACHED_LENGTH:
                    if len(cache) >= CACHE:
                        cache.clear()
                    cache[part] = found
            extend(found)
        return ids

    def decode(self, ids: list[int]) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters."""
        return b"".join(map(self.model.surface.__getitem__, ids)).decode("utf-8", "replace")[1:]


def encode_texts(docs: DataFrame, model: PieceModel, text: str = "text") -> DataFrame:
    """Add token_ids, n_tokens and round_trip (whether decoding gives the text back) to every row.

    Null and empty texts have no tokens and come back empty, which counts as a round trip. Whole texts are encoded.
    Repeated rows stay repeated; input columns that have one of the new names are replaced.
    """
    docs = docs.drop("token_ids", "n_tokens", "round_trip")

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model)
        for batch in batches:
            counts, flat, exact = [], [], []
            for value in batch[text]:
                source = value.as_py() or ""
                ids = encoder.encode(source)
                exact.append(encoder.decode(ids) == source)
                counts.append(len(ids))
                flat.append(np.array(ids, np.int32))
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(flat) if flat else np.zeros(0, np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists, pa.array(counts, pa.int64()), pa.array(exact, pa.bool_())], names=[*batch.schema.names, "token_ids", "n_tokens", "round_trip"])

    added = StructType.fromDDL("token_ids array<int>, n_tokens long, round_trip boolean")
    return docs.mapInArrow(encoded, StructType([*docs.schema.fields, *added.fields]))


def decode_ids(docs: DataFrame, model: PieceModel, ids: str = "token_ids") -> DataFrame:
    """Add column decoded, the text of the ids; null ids give an empty text."""
    docs = docs.drop("decoded")

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model)
        for batch in batches:
            texts = [encoder.decode(value.as_py() or []) for value in batch[ids]]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"])

    return docs.mapInArrow(decoded, StructType([*docs.schema.fields, *StructType.fromDDL("decoded string").fields]))
