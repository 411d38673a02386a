"""Token ids of whole texts by a public vocabulary, with a cache of words.

The vocabulary's pre-tokenizer drops white space and never looks across it, so the ids of a
text are the ids of its ASCII-white-space chunks one after another: no character composes or
changes case across an ASCII space.  A last full stop or comma after an ASCII letter is a
token run of its own too and the vocabulary lower-cases ASCII letters, so a chunk is a core and
perhaps a tail, and each distinct core is encoded once per worker.  Cores, their
ids and the gathering are Arrow columns; no Python object is made for a word that is known.  The
cache keeps the last batch's cores when it is full; results don't depend on it.
"""

from __future__ import annotations

import os
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

VOCABULARY = "word_bpe_49k.json"
PLAIN = "^[A-Za-z]+$"
TAILED = "[A-Za-z][.,]$"
TAILS = [".", ","]


class WordEncoder:
    """Encodes batches of texts; one for each worker process and vocabulary."""

    _made: dict[str, WordEncoder] = {}

    def __init__(self, vocabulary: str, most_words: int = 500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        ends = [i for word, i in self.tokenizer.get_vocab().items() if word.endswith("</w>")]
        self.ends = np.zeros(self.tokenizer.get_vocab_size() + 1, dtype=bool)
        self.ends[ends] = True
        self.most_words = most_words
        # ids[i]: the little-endian 32-bit ids of words[i].
        self.words, self.ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())
        self.tails = pa.concat_arrays([pa.array([b""], pa.large_binary()), self._encoded(pa.array(TAILS, pa.large_string()))])

    @classmethod
    def of(cls, vocabulary: str) -> WordEncoder:
        if vocabulary not in cls._made:
            cls._made[vocabulary] = cls(vocabulary)
        return cls._made[vocabulary]

    def _encoded(self, words: pa.Array) -> pa.Array:
        """The ids of each word. Runs of ASCII letters are single words of the vocabulary's
        pre-tokenizer, so many of them go through as one text and are cut at the word ends."""
        is_plain = np.asarray(pc.match_substring_regex(words, PLAIN))
        plain, odd = words.filter(pa.array(is_plain)), words.filter(pa.array(~is_plain))
        ids, sizes = [np.zeros(0, dtype="<u4")], [np.zeros(0, dtype=np.int64)]
        if len(plain):
            bounds = pa.array([*range(0, len(plain), 256), len(plain)], pa.int64())
            texts = pc.binary_join(pa.LargeListArray.from_arrays(bounds, plain), pa.scalar(" ", pa.large_string())).to_pylist()
            found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            ids.append(np.concatenate([np.array(x.ids, dtype="<u4") for x in found]))
            sizes.append(np.diff(np.flatnonzero(self.ends[ids[-1]]), prepend=-1))
        if len(odd):
            found = [x.ids for x in self.tokenizer.encode_batch_fast(odd.to_pylist(), add_special_tokens=False)]
            sizes.append(np.fromiter(map(len, found), dtype=np.int64, count=len(found)))
            ids.append(np.fromiter(chain.from_iterable(found), dtype="<u4", count=int(sizes[-1].sum())))
        bounds = np.concatenate([[0], 4 * np.cumsum(np.concatenate(sizes))]).astype(np.int64)
        made = pa.Array.from_buffers(pa.large_binary(), len(words), [None, pa.py_buffer(bounds), pa.py_buffer(np.concatenate(ids))])
        # The plain words come first there; back into the order asked for.
        place = np.empty(len(words), dtype=np.int64)
        place[np.concatenate([np.flatnonzero(is_plain), np.flatnonzero(~is_plain)])] = np.arange(len(words))
        return made.take(pa.array(place))

    def _ids(self, cores: pa.Array) -> pa.Array:
        """The ids of different cores; those not met before become known."""
        at = pc.index_in(cores, value_set=self.words)
        if at.null_count:
            new = cores.filter(at.is_null())
            known = len(self.words)
            self.words = pa.concat_arrays([self.words, new])
            self.ids = pa.concat_arrays([self.ids, self._encoded(new)])
            places = np.asarray(at.fill_null(0)).astype(np.int64)
            places[np.asarray(at.is_null())] = known + np.arange(len(new))
            at = pa.array(places)
        ids = self.ids.take(at)
        if len(self.words) > self.most_words:
            self.words, self.ids = cores, ids
        return ids

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts (null: none) one after another, and the number of each text."""
        words = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
        flat, bounds = words.flatten(), np.asarray(words.offsets).astype(np.int64)
        bounds = bounds - bounds[0]
        coded = flat.dictionary_encode()
        chunks = coded.dictionary
        # Which tail: none, full stop or comma.
        tailed = pc.match_substring_regex(chunks, TAILED)
        tail = pc.if_else(tailed, pc.if_else(pc.ends_with(chunks, TAILS[0]), 1, 2), 0)
        core = pc.if_else(tailed, pc.utf8_slice_codeunits(chunks, 0, -1), chunks)
        core = pc.if_else(pc.match_substring_regex(core, PLAIN), pc.ascii_lower(core), core).dictionary_encode()
        ids = self._ids(core.dictionary).take(core.indices)
        ids = pc.binary_join_element_wise(ids, self.tails.take(tail), pa.scalar(b"", pa.large_binary()))
        found = ids.take(coded.indices)
        # A column of binary values lies in one piece: the offsets of its values are those of the ids.
        upto = np.frombuffer(found.buffers()[1], dtype=np.int64, count=len(found) + 1, offset=8 * found.offset) // 4 if len(found) else np.zeros(1, np.int64)
        every = np.frombuffer(found.buffers()[2] or b"", dtype="<u4") if len(found) else np.zeros(0, "<u4")
        return every[upto[0] : upto[-1]], upto[bounds[1:]] - upto[bounds[:-1]]
