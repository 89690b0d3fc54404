"""Token ids of whole texts by a public tokenizer, with each distinct word of a group of texts encoded once.

The tokenizers library takes around 0.8 s per million characters. Its pre-tokenizers never let a token reach over a
blank that follows a visible character, over a line end between visible characters, or from a letter into punctuation. So
Arrow cuts texts there and finds the distinct pieces of a group, the library encodes those, and the ids of a text are those
of its pieces in a row. `tests/llm/test_tokens.py` compares with the library on whole texts.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tripweave.llm.common import kept_by_worker, single_threaded

#: Texts are encoded in groups of so many bytes.
GROUP_BYTES = 4 << 20
#: Pieces that a worker remembers with their ids (some 40 bytes each); later ones are encoded in each group anew.
REMEMBERED = 300_000
#: Pieces that the library encodes at a time.
ENCODED = 8_192
CUT = "\x1f"
#: What any Unicode version or Python counts as white space.
SPACE_SET = r"\t-\r \x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200b}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}"
VISIBLE = f"[^{SPACE_SET}]"
BEFORE_BLANK = (f"({VISIBLE}) ", rf"\1{CUT} ")
AT_LINE_END = (f"({VISIBLE})\n({VISIBLE})", f"\\1{CUT}\n{CUT}\\2")
AFTER_LETTER = (r"([a-zA-Z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{ff}])([.,!?;:*|#%&$])", rf"\1{CUT}\2")


class WordEncoder:
    """Ids of texts by a tokenizer file.

    spaced: the tokenizer keeps white space (byte-level); else it drops it and lowers case, so that blanks and line ends
    are cut out and A-Z need not be told from a-z.
    """

    def __init__(self, path: str, spaced: bool, dtype: str) -> None:
        single_threaded()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.spaced, self.dtype = spaced, np.dtype(dtype)
        self.known = pa.array([], pa.string())
        self.ids, self.starts, self.lengths = np.zeros(0, self.dtype), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def cut(self, texts: pa.Array) -> pa.Array:
        """Lists of pieces; a text that holds the mark itself stays in one piece."""
        marked = pc.match_substring(texts, CUT)
        if self.spaced:
            uneven = pc.match_substring_regex(texts, f"[{SPACE_SET}] ")
            out = pc.replace_substring(texts, " ", f"{CUT} ")
            if pc.any(uneven).as_py():
                out = pc.replace_with_mask(out, uneven, pc.replace_substring_regex(texts.filter(uneven), *BEFORE_BLANK))
            for pattern, by in (AT_LINE_END, AFTER_LETTER):
                out = pc.replace_substring_regex(out, pattern, by)
        else:
            out = pc.replace_substring(pc.replace_substring(pc.ascii_lower(texts), " ", CUT), "\n", CUT)
            out = pc.replace_substring_regex(out, *AFTER_LETTER)
        lists = pc.split_pattern(out, CUT)
        if not pc.any(marked).as_py():
            return lists
        return pa.array([[t] if m else x for t, m, x in zip(texts.to_pylist(), marked.to_pylist(), lists.to_pylist())], pa.list_(pa.string()))

    def encode_all(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For groups of neighbouring texts: all ids in a row, and the border before each text and after the last."""
        sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        group = (np.cumsum(sizes, dtype=np.int64) - 1) // GROUP_BYTES
        borders = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(texts)]
        for at, end in zip(borders, borders[1:]):
            if end > at:
                yield self._group(texts.slice(at, end - at))

    def _group(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        lists = self.cut(texts)
        offsets = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))])
        coded = lists.flatten().dictionary_encode()
        codes = coded.indices.to_numpy()
        joined, starts, lengths = self._pieces(coded.dictionary)
        counts = lengths[codes]
        ends = np.cumsum(counts)
        out = joined[np.repeat(starts[codes] - (ends - counts), counts) + np.arange(counts.sum())]
        return out, np.concatenate([[0], ends])[offsets]


    def _pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct pieces: an array of ids with each piece's start and length in it."""
        at = pc.index_in(pieces, value_set=self.known)
        unknown = pc.is_null(at)
        new = pieces.filter(unknown)
        # The library's own rows are far larger than the ids, so they are taken in parts.
        ids = [e.ids for k in range(0, len(new), ENCODED) for e in self.tokenizer.encode_batch_fast(new.slice(k, ENCODED).to_pylist(), add_special_tokens=False)]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        joined = np.concatenate([self.ids, np.frombuffer(array("I", chain.from_iterable(ids)), np.uint32).astype(self.dtype)])
        all_starts = np.concatenate([self.starts, np.cumsum(lengths) - lengths + len(self.ids)])
        all_lengths = np.concatenate([self.lengths, lengths])
        place = pc.fill_null(at, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        place[unknown.to_numpy(zero_copy_only=False)] = len(self.starts) + np.arange(len(new))
        if len(self.known) < REMEMBERED:
            self.known = pa.concat_arrays([self.known, new])
            self.ids, self.starts, self.lengths = joined, all_starts, all_lengths
        return joined, all_starts[place], all_lengths[place]


def encoder(path: str, spaced: bool, dtype: str) -> WordEncoder:
    """The worker's encoder for these settings, kept from task to task."""
    return kept_by_worker(("tokens", path, spaced, dtype), lambda: WordEncoder(path, spaced, dtype))
