"""Token ids of whole texts, each different word encoded once per slice of texts.

The word tokenizer lower-cases, drops white space and merges only inside a unit (a run of
letters, one digit, or a run of signs).  So a text's ids are those of its pieces between
blanks and line ends, and a piece's ids are those of its units.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

# Units of a lower-cased piece of the first 256 code points, in which nothing composes.
UNIT = r"'(?:s|t|re|ve|m|ll|d)|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼-¾]|[^\t-\r \x85\xa0a-zªµºß-öø-ÿ0-9²³¹¼-¾]+"
UNITS = re.compile(UNIT)
# Pieces that are cut into units all at once: no blanks of any kind, no markers.
PLAIN = "^[!-~¡-ÿ]+$"
MARKERS = re.compile(r"<\|(?:startoftext|endoftext)\|>")
# Entries of a cache: met again, met once.  The cache of units takes about 80 MB when full; few pieces need theirs.
KNOWN, NEW = 150_000, 250_000
# Bytes of text taken at a time, which bounds memory; a longer text is its own slice.
SLICE_BYTES = 8 << 20


class Cache(dict):
    """Text met at least twice -> what ``make`` gives for it.

    Most words of a large corpus are met once; they wait in a small cache that is
    emptied when full, and move here when met again.
    """

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__()
        self.make = make
        self.new: dict[str, bytes] = {}

    def __missing__(self, text: str) -> bytes:
        found = self.new.pop(text, None)
        if found is not None:
            if len(self) >= KNOWN:
                self.clear()
            self[text] = found
            return found
        found = self.make(text)
        if len(self.new) >= NEW:
            self.new.clear()
        self.new[text] = found
        return found


class TokenIds:
    """Ids as little-endian 32-bit bytes, of units and of pieces."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        self.largest = max(self.tokenizer.get_vocab(with_added_tokens=True).values())
        to_bytes = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.as_bytes = str.maketrans({chr(at): to_bytes(chr(at))[0][0] for at in range(0x100)})
        self.units, self.pieces = Cache(self.unit), Cache(self.piece)

    def unit(self, unit: str) -> bytes:
        return packed([token.id for token in self.merge(unit.translate(self.as_bytes))])

    def piece(self, piece: str) -> bytes:
        """Ids of what stands between blanks."""
        if not piece.isascii() and max(piece) > "ÿ" or "<|" in piece and MARKERS.search(piece):
            return packed(self.tokenizer.encode(piece, add_special_tokens=False).ids)
        return b"".join(map(self.units.__getitem__, UNITS.findall(piece.lower())))

    def piece_table(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids in a row, and where in them each piece's begin and how many they are."""
        plain = pc.and_not(pc.match_substring_regex(pieces, PLAIN), pc.match_substring(pieces, "<|"))
        spaced = pc.replace_substring_regex(pc.utf8_lower(pieces.filter(plain)), f"({UNIT})", "\\1 ")
        units = pc.split_pattern(spaced, " ")
        coded = units.flatten().dictionary_encode()
        known = list(map(self.units.__getitem__, coded.dictionary.to_numpy(zero_copy_only=False).tolist()))
        of_unit = np.fromiter(map(len, known), np.int64, len(known)) // 4
        ids, ends = spread(
            np.frombuffer(b"".join(known), "<u4"), np.cumsum(of_unit) - of_unit, of_unit, coded.indices.to_numpy()
        )
        cuts = np.concatenate([[0], ends])[units.offsets.to_numpy() - units.offsets[0].as_py()]
        other = list(map(self.pieces.__getitem__, pieces.filter(pc.invert(plain)).to_numpy(zero_copy_only=False).tolist()))
        of_other = np.fromiter(map(len, other), np.int64, len(other)) // 4
        is_plain = plain.to_numpy(zero_copy_only=False)
        sizes, begins = np.empty(len(pieces), np.int64), np.empty(len(pieces), np.int64)
        sizes[is_plain], begins[is_plain] = np.diff(cuts), cuts[:-1]
        sizes[~is_plain], begins[~is_plain] = of_other, len(ids) + np.cumsum(of_other) - of_other
        return np.concatenate([ids, np.frombuffer(b"".join(other), "<u4")]), begins, sizes

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's begin (one more entry: the end)."""
        words = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        coded = words.flatten().dictionary_encode()
        ids, ends = spread(*self.piece_table(coded.dictionary), coded.indices.to_numpy())
        offsets = np.concatenate([[0], ends])[words.offsets.to_numpy() - words.offsets[0].as_py()]
        return ids, offsets


def spread(table: np.ndarray, begins: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches of ``table`` numbered ``at``, one after the other, and where each ends."""
    size = sizes[at]
    ends = np.cumsum(size)
    # Where in the table a stretch begins, less where it begins in the result.
    place = np.repeat(begins[at] - (ends - size), size)
    place += np.arange(len(place))
    return table[place], ends


def packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


@lru_cache(maxsize=2)
def token_ids(path: str) -> TokenIds:
    """One encoder per worker and file."""
    return TokenIds(path)


def slices(
    batches: Iterable[pa.RecordBatch], most_bytes: int = SLICE_BYTES
) -> Iterator[tuple[pa.Array, pa.Array]]:
    """(keys, texts) of the two columns, dealt anew into slices of at most ``most_bytes``.

    Small batches are joined, as each slice encodes a different word once; a longer text
    is a slice by itself.
    """
    held, size = [], 0
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
        at = 0
        while at < len(sizes):
            fitting = int(np.searchsorted(np.cumsum(sizes[at:]), most_bytes - size, "right"))
            if not fitting and held:
                yield _joined(held)
                held, size = [], 0
                continue
            until = at + max(1, fitting)
            held.append((batch.column(0).slice(at, until - at), batch.column(1).slice(at, until - at)))
            size += int(sizes[at:until].sum())
            at = until
    if held:
        yield _joined(held)


def _joined(held: list[tuple[pa.Array, pa.Array]]) -> tuple[pa.Array, pa.Array]:
    return pa.concat_arrays([keys for keys, _ in held]), pa.concat_arrays([texts for _, texts in held])


def with_end(ids: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same ids with ``end_id`` after each text, and the new offsets."""
    count = len(offsets) - 1
    moved = offsets + np.arange(count + 1)
    out = np.full(len(ids) + count, end_id, "<u4")
    inside = np.ones(len(out), bool)
    inside[moved[1:] - 1] = False
    out[inside] = ids
    return out, moved
