"""Token ids of whole texts, by the tokenizers library, inside Arrow batches.

A byte-level BPE merges nothing across the start of white space, nor from a letter or digit into a
mark behind it, so a text is encoded piece by piece: white space, marks, and the letters behind
them. Pieces repeat a lot, and a Python worker encodes most different ones once. Texts with white
space outside ASCII are encoded in one go, since what counts as white space there is the
tokenizer's own affair, and so are those with an opening of a special token.
"""

import gc
import os
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

# White space, then marks, then letters and digits, as many as there are of each.
PIECE = re.compile(
    r"[ \t\n\r]*+(?:[^\W_]++|[^\w \t\n\r]*+(?:_[^\w \t\n\r]*+)*+[^\W_]*+)")
# A space, if any, and letters of the Latin blocks: one unit for a byte-level tokenizer's own pattern.
WORD = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ɏ]+")
WHOLE = re.compile(
    r"[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028\u2029\u202f\u205f\u2060\u3000"
    r"\ufeff]")
WHOLE_ASCII = re.compile(r"[\x0b\x0c\x1c-\x1f]")
OPENING = "<|"
# Characters of text handled at a time, and pieces that a Python worker remembers.
SLICE_CHARS = 4_000_000
CACHED_PIECES = 800_000
# New pieces that go through the tokenizer as one text.
TOGETHER = 2000


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level tokenizers have for each byte: its own if it can be seen."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in seen]
    return {byte: chr(byte) for byte in seen} | {
        byte: chr(256 + i) for i, byte in enumerate(others)}


BYTE_LETTERS = _byte_letters()


def in_one_go(text: str) -> bool:
    """Whether a text cannot be cut into pieces here."""
    return OPENING in text or (WHOLE_ASCII if text.isascii() else WHOLE).search(text) is not None


class Encoder:
    """Encodes lists of texts into int32 ids, remembering pieces between calls.

    The first pieces met are kept, which are mostly the frequent ones.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks fill the cores
        self.tokenizer = Tokenizer.from_file(path)
        self.kept: dict[str, bytes] = {"": b""}  # each text ends with an empty piece
        self.mark = self._mark()
        own = self.tokenizer.pre_tokenizer
        # Words, which the pattern would leave as they are, may go to the model directly.
        self.direct = (
            isinstance(own, ByteLevel) and not own.add_prefix_space
            and self.tokenizer.normalizer is None and self.tokenizer.truncation is None
            and self.tokenizer.padding is None and not any(
                WORD.fullmatch(t.content) or not t.content.strip()
                for t in self.tokenizer.get_added_tokens_decoder().values()))

    def _mark(self) -> tuple[str, int] | None:
        """A special token that may stand between pieces, with its id, if the tokenizer has one.

        It cuts a text wherever it is found, and no piece can hold it, as it is not of their form.
        """
        for token_id, token in self.tokenizer.get_added_tokens_decoder().items():
            bent = token.lstrip or token.rstrip or token.single_word or token.normalized
            if token.special and not bent and not PIECE.fullmatch(token.content):
                return token.content, token_id
        return None

    def _encode(self, texts: list[str]) -> list[bytes]:
        done = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("i", one.ids).tobytes() for one in done]

    def _joined(self, pieces: list[str]) -> list[bytes]:
        """Like :meth:`_encode` for pieces, which costs less than one call's result for each."""
        if self.mark is None:
            return self._encode(pieces)
        mark, mark_id = self.mark
        done = []
        for at in range(0, len(pieces), TOGETHER):
            [ids] = self._encode([mark.join([*pieces[at:at + TOGETHER], ""])])
            ends = np.flatnonzero(np.frombuffer(ids, np.int32) == mark_id) * 4
            starts = np.concatenate(([0], ends[:-1] + 4))
            done += [ids[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        return done

    def _words(self, words: list[str]) -> list[bytes]:
        """Like :meth:`_encode` for words, by the model alone, in its own letters for bytes."""
        letters = "\n".join(words).encode().decode("latin-1").translate(BYTE_LETTERS)
        tokenize = self.tokenizer.model.tokenize
        return [array("i", [token.id for token in tokenize(word)]).tobytes()
                for word in letters.split(BYTE_LETTERS[10])] if words else []

    def _encode_pieces(self, pieces: Iterable[str]) -> dict[str, bytes]:
        """The ids of each piece; words do without the rest of the tokenizer."""
        words, others = [], []
        for piece in pieces:
            (words if self.direct and WORD.fullmatch(piece) else others).append(piece)
        found = dict(zip(words, self._words(words), strict=True))
        found.update(zip(others, self._joined(others), strict=True))
        return found

    def __call__(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian int32 bytes."""
        # Long lists of pieces and no cycles: collections would only walk through them.
        collecting = gc.isenabled()
        gc.disable()
        try:
            return self._ids(texts)
        finally:
            if collecting:
                gc.enable()

    def _ids(self, texts: list[str]) -> list[bytes]:
        kept = self.kept
        whole, pieces, bounds = [], [], [0]
        for text in texts:
            if in_one_go(text):
                whole.append(text)
            else:
                pieces += PIECE.findall(text)  # at least an empty one, at the end
            bounds.append(len(pieces))
        rest = iter(self._encode(whole))
        # Each piece is looked up once.
        ids = list(map(kept.get, pieces))
        unknown = [i for i, own in enumerate(ids) if own is None]
        found = self._encode_pieces(dict.fromkeys([pieces[i] for i in unknown]))
        for i in unknown:
            ids[i] = found[pieces[i]]
        if len(kept) + len(found) <= CACHED_PIECES:
            kept.update(found)
        return [b"".join(ids[a:b]) if a < b else next(rest) for a, b in pairwise(bounds)]


@lru_cache(maxsize=2)
def shared_encoder(path: str) -> Encoder:
    """The encoder of this Python worker, which lives on from task to task."""
    return Encoder(path)


def slices(texts: list[str], limit: int = SLICE_CHARS) -> Iterator[list[str]]:
    """``texts`` in order, in lists of at most ``limit`` characters or one text."""
    part, size = [], 0
    for text in texts:
        if part and size + len(text) > limit:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part


def encoded(batches: Iterator[pa.RecordBatch], path: str, text: str = "text"):
    """For each slice of the batches: its other columns, and the ids of its texts as bytes."""
    encoder = shared_encoder(path)
    for batch in batches:
        at, others = 0, batch.drop_columns([text])
        for part in slices(batch.column(text).to_pylist()):
            yield others.slice(at, len(part)), encoder(part)
            at += len(part)
