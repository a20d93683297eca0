"""SentencePiece encoding and decoding by shared-prefix Viterbi.

A text is a row of marked words (a blank and what follows up to the next one);
no piece of the vocabulary reaches over a word's end, so the best segmentation
of a text is that of its words. Distinct words are sorted, which is a
depth-first walk of their trie: a word takes over the forward scores of the
prefix that it shares with the word before it and computes the rest only.
Words found are kept (bounded) for the texts and tasks that follow in the worker.

The vocabulary file states an order of pieces, not probabilities; a piece's
log probability is Zipf's law on its rank. A character without a piece is
written as its UTF-8 bytes, so decoding gives every text back exactly.

One scan, one Arrow pass. Defined results: null and empty texts have no pieces
and decode to the empty text; texts of any length are coded whole; repeated rows
are coded each; of equal segmentations the one with the longer last piece wins;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from tradewh.llm.common import pick

VOCABULARY = "piece_bpe_32k.model"
#: Zipf's law: a piece of rank r has a probability in proportion to 1 / (r + RANK_OFFSET).
RANK_OFFSET = 10
_MARKED = re.compile(r" *[^ ]+| +")


@dataclass
class Vocabulary:
    """Pieces with their mark as a blank; ``logp`` by id; byte pieces by value."""

    ids: dict[str, int]
    raw: list[bytes]
    logp: list[float]
    bytes_: list[int]
    longest: int
    #: Every ending of a piece: its id if it is a piece itself, else -1.
    endings: dict[str, int]


_KEPT: dict[str, Vocabulary] = {}


def vocabulary(name: str = VOCABULARY) -> Vocabulary:
    if name not in _KEPT:
        import public_tokenizers
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=public_tokenizers.path(name))
        n = sp.get_piece_size()
        ids, raw, byte_ids = {}, [b""] * n, [0] * 256
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        for i in range(n):
            if sp.is_byte(i):
                value = int(sp.id_to_piece(i)[3:-1], 16)
                raw[i], byte_ids[value] = bytes([value]), i
        for i in plain:
            piece = sp.id_to_piece(i).replace("▁", " ")
            ids[piece], raw[i] = i, piece.encode()
        ranked = sorted(plain, key=lambda i: (-sp.get_score(i), i)) + byte_ids
        total = math.log(sum(1 / (r + RANK_OFFSET) for r in range(len(ranked))))
        logp = [-math.inf] * n
        for r, i in enumerate(ranked):
            logp[i] = -math.log(r + RANK_OFFSET) - total
        endings = {piece[k:]: -1 for piece in ids for k in range(len(piece))}
        _KEPT[name] = Vocabulary(ids, raw, logp, byte_ids, max(map(len, ids)), endings | ids)
    return _KEPT[name]


def segment(words: Iterable[str], v: Vocabulary) -> Iterator[tuple[str, list[int]]]:
    """(word, ids of its best segmentation) of distinct words, in sorted order.

    Of equal scores the longer last piece wins. Last pieces are tried from the
    shortest on, until what stands before the place ends no piece of any length.
    """
    ends, logp = v.endings.get, v.logp
    best, back, last = [0.0], [(0, ())], ""
    for word in sorted(words):
        n, shared = min(len(word), len(last)), 0
        while shared < n and word[shared] == last[shared]:
            shared += 1
        del best[shared + 1:], back[shared + 1:]
        for j in range(shared + 1, len(word) + 1):
            top, frm = -math.inf, None
            i = j - 1
            while i >= 0 and (piece := ends(word[i:j])) is not None:
                if piece >= 0 and (s := best[i] + logp[piece]) >= top:
                    top, frm = s, (i, (piece,))
                i -= 1
            if v.ids.get(word[j - 1]) is None:  # a character without a piece: its bytes
                spelt = [v.bytes_[b] for b in word[j - 1].encode("utf-8", "surrogatepass")]
                if (s := best[j - 1] + sum(logp[b] for b in spelt)) > top:
                    top, frm = s, (j - 1, spelt)
            best.append(top)
            back.append(frm)
        ids, j = [], len(word)
        while j:
            j, part = back[j]
            ids += reversed(part)
        ids.reverse()
        last = word
        yield word, ids


def marked_words(text: str) -> list[str]:
    """The words of a text behind the leading blank; joined they are the text."""
    if not text:
        return []
    if "  " in text or text[0] == " " or text[-1] == " ":
        return _MARKED.findall(" " + text)
    return [" " + w for w in text.split(" ")]


class PieceEncoder:
    """``encode`` texts to ids (little-endian, 32 bits) and ``decode`` them."""

    def __init__(self, name: str = VOCABULARY, most: int = 600_000):
        self.v, self.most, self.known = vocabulary(name), most, {}

    def learn(self, words: set[str]) -> None:
        """Words of many texts at a time, so that they share their prefixes."""
        new = words.difference(self.known)
        if len(self.known) + len(new) > self.most:
            self.known.clear()
            new = words
        for word, ids in segment(new, self.v):
            self.known[word] = array("I", ids).tobytes()

    def encode_all(self, texts: list[str]) -> Iterator[tuple[int, bytes]]:
        """(words, ids) of each text; the texts are split once."""
        split = [marked_words(t) for t in texts]
        self.learn(set().union(*split))
        for words in split:
            yield len(words), b"".join(map(self.known.__getitem__, words))

    def encode(self, text: str | None) -> bytes:
        return next(self.encode_all([text or ""]))[1]

    def decode(self, ids: bytes) -> str:
        raw = b"".join(map(self.v.raw.__getitem__, array("I", ids)))
        return raw.decode("utf-8", "surrogatepass")[1:]


_ENCODERS: dict[str, PieceEncoder] = {}


def piece_encoder(name: str = VOCABULARY) -> PieceEncoder:
    """One encoder per vocabulary and worker process, so that words are learnt once for its tasks."""
    if name not in _ENCODERS:
        _ENCODERS[name] = PieceEncoder(name)
    return _ENCODERS[name]


def _slices(texts: list[str], chars: int = 4_000_000) -> Iterator[list[str]]:
    """Runs of texts of some ``chars`` characters (or one longer text)."""
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t)
        if size >= chars:
            yield part
            part, size = [], 0
    if part:
        yield part


def encode_documents(docs: DataFrame, name: str = VOCABULARY, with_ids: bool = False) -> DataFrame:
    """doc_id, n_words, n_pieces, ids_crc32, text_crc32 (of what the ids decode
    to, UTF-8), round_trip (whether that is the text), on demand the ids."""
    names = ["doc_id", "n_words", "n_pieces", "ids_crc32", "text_crc32", "round_trip"] + ["ids"] * with_ids
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = piece_encoder(name)
        for batch in batches:
            out: list[list] = [[] for _ in names]
            doc_ids, texts = batch.column("doc_id").to_pylist(), [t or "" for t in batch.column("text").to_pylist()]
            coded = ((t, n, ids) for part in _slices(texts) for t, (n, ids) in zip(part, coder.encode_all(part)))
            for doc_id, (text, n_words, ids) in zip(doc_ids, coded):
                back = coder.decode(ids)
                row = (doc_id, n_words, len(ids) // 4, zlib.crc32(ids),
                       zlib.crc32(back.encode("utf-8", "surrogatepass")), back == text, ids)
                for col, x in zip(out, row):
                    col.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names)

    return pick(docs, doc_id="long", text="string").mapInArrow(
        run, "doc_id long, n_words long, n_pieces long, ids_crc32 long, text_crc32 long, round_trip boolean" + ", ids binary" * with_ids)
