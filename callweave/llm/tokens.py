"""Token ids by the tokenizers library, each distinct piece of text encoded once per worker.

A byte-level tokenizer whose pre-tokens never reach over a change from white space to other
characters (but for one leading space) gives a text the ids of its pieces one after
another. Pieces repeat, so their ids are kept: the library sees a piece once. A text with
a special token in it is encoded whole, since that splits it before the pieces do.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from callweave.llm.common import one_array, ranges, worker_cache

#: White space of Unicode.
WHITE = "\t-\r \x85\xa0  -     　"
PIECE = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
#: Before pieces without a space before them; texts that hold it are not plain.
GLUE = "\0"
#: Pieces that a worker remembers; twice as many while the older half is still in use.
KEPT_PIECES = 250_000
#: Bytes of text that are encoded at a time.
ENCODED_BYTES = 3 << 20


#: Pieces that are empty or have white space at an edge.
EDGE = f"^$|^[{WHITE}]|[{WHITE}]$"


def _flags(column) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(bool)


class Encoder:
    """Ids of texts, in the order of the texts."""

    def __init__(self, file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # cores belong to other tasks
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(file)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @classmethod
    def of_worker(cls, file: str) -> Encoder:
        cache = worker_cache()
        if ("encoder", file) not in cache:
            cache["encoder", file] = cls(file)
        return cache["encoder", file]

    def _ids(self, texts: list[str]) -> list[bytes]:
        made = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in made]

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of distinct pieces, from memory where they are known."""
        if len(self.known) > KEPT_PIECES:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        found = list(map(known.get, pieces))
        missing = []
        for p in [p for p, ids in zip(pieces, found) if ids is None]:
            if p in older:
                known[p] = older[p]
            else:
                missing.append(p)
        for i in range(0, len(missing), 20_000):
            part = missing[i : i + 20_000]
            known.update(zip(part, self._ids(part)))
        return [known[p] if ids is None else ids for p, ids in zip(pieces, found)]

    def _odd(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return self._ids([text])[0]
        pieces = PIECE.findall(text)
        distinct = list(set(pieces))
        found = dict(zip(distinct, self._pieces(distinct)))
        return b"".join(map(found.__getitem__, pieces))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each text's begin in them (one more than texts).

        Plain texts, in which single spaces and line ends stand between other characters, are
        split and made distinct by Arrow; a space belongs to the piece after it, unless that
        begins with ``GLUE``. Line ends are pieces, and so are points and commas between a letter
        and a space, where a pre-token ends anyway. All others, also those with other white
        space at the edge of a piece, go through ``PIECE``.
        """
        texts = one_array(texts).cast(pa.large_string()).fill_null("")
        cut = pc.replace_substring(texts, "\n", f" {GLUE}\n {GLUE}")
        cut = pc.replace_substring_regex(cut, "([A-Za-zÀ-ɏ])([.,]) ", f"\\1 {GLUE}\\2 ")
        split = pc.split_pattern(cut, " ")
        first = split.offsets.to_numpy() - split.offsets[0].as_py()
        coded = split.flatten().dictionary_encode()
        codes, words = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
        glued = _flags(pc.starts_with(words, GLUE))
        words = pc.replace_substring_regex(words, f"^{GLUE}", "")
        odd_word = _flags(pc.match_substring_regex(words, EDGE)) & ~_flags(pc.equal(words, "\n"))
        for s in self.special:
            odd_word |= _flags(pc.match_substring(words, s))
        odd_piece = np.r_[0, np.cumsum(odd_word[codes])] if len(codes) else np.zeros(1, np.int64)
        odd = odd_piece[first[1:]] > odd_piece[first[:-1]]
        if any(" " in s for s in self.special):
            odd |= np.array([any(s in t for s in self.special) for t in texts.to_pylist()], dtype=bool)
        odd |= _flags(pc.match_substring(texts, GLUE))
        alone = glued[codes] if len(codes) else np.zeros(0, bool)
        alone[first[:-1][first[:-1] < len(codes)]] = True
        key = codes.astype(np.int64) * 2 + alone
        used = np.zeros(2 * len(words), bool)
        used[key[~np.repeat(odd, np.diff(first))]] = True
        wanted = np.flatnonzero(used)
        whole = words.take(pa.array(wanted >> 1))
        spaced = pc.binary_join_element_wise(pa.scalar(" ", whole.type), whole, pa.scalar("", whole.type))
        found = self._pieces(pc.if_else(pa.array((wanted & 1).astype(bool)), whole, spaced).to_pylist())
        place = np.zeros(2 * len(words) + 1, np.int64)
        place[wanted] = np.arange(len(wanted))
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        begin = np.cumsum(size) - size
        pool = np.frombuffer(b"".join(found), dtype="<u4")
        out, counts = [], np.zeros(len(texts), np.int64)
        edges = np.flatnonzero(np.diff(np.r_[False, odd, False])).tolist()
        at = 0
        for a, b in zip([*edges, len(texts)], [*edges[1:], len(texts), len(texts)]):
            if at < a:  # plain texts
                k = place[key[first[at] : first[a]]]
                out.append(pool[ranges(begin[k], size[k])])
                sums = np.r_[0, np.cumsum(size[k])]
                counts[at:a] = np.diff(sums[first[at : a + 1] - first[at]])
                at = a
            if a < b and odd[a]:
                for i in range(a, b):
                    ids = np.frombuffer(self._odd(texts[i].as_py()), dtype="<u4")
                    out.append(ids)
                    counts[i] = len(ids)
                at = b
        pa.default_memory_pool().release_unused()
        return np.concatenate([np.zeros(0, "<u4"), *out]), np.r_[0, np.cumsum(counts)]
