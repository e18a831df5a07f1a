"""Token ids by the tokenizers library, with the ids of frequent words remembered.

Both tokenizer kinds used here split a text into words first and never merge across them. A text
made of ASCII and accented Latin letters only is split here, by the tokenizer's own published
pattern, and each distinct word is given to the library's model once and remembered. Any other
text, and any that may hold a special token, goes to the library whole. The ids are the same.
"""

from __future__ import annotations

import itertools
import json
import re
import struct
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from tokenizers import Tokenizer

from tripkit.llm.columnar import buffers
from tripkit.llm.pieces import WHITE, stretch_starts

#: Texts of these characters alone are split here; all Unicode versions agree on their classes.
PLAIN = re.compile(r"[\t\n\r -~À-ÖØ-öø-ÿ]*")
#: The bytes of such texts.
PLAIN_BYTES = np.zeros(256, bool)
PLAIN_BYTES[[9, 10, 13, *range(32, 127), *range(0x80, 0xC0), 0xC3]] = True
# The word patterns of the two public vocabularies, for such texts.
BYTE_WORDS = re.compile(r"'(?:[stmd]|re|ve|ll)| ?[A-Za-zÀ-ÖØ-öø-ÿ]+| ?[0-9]+| ?[!-/:-@\[-`{-~]+|\s+(?!\S)|\s+")
LOWER_WORDS = re.compile(r"'(?:[stmd]|re|ve|ll)|[a-zà-öø-ÿß]+|[0-9]|[!-/:-@\[-`{-~]+")
#: How a tokenizer file that uses them describes its splitting.
BYTE_SPLIT = "ByteLevel(add_prefix_space=False, trim_offsets=True, use_regex=True)"
#: The same pattern for any text.
BYTE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LOWER_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: Words remembered by one task: the latest, and those met again of the ones before.
REMEMBERED = 300_000

#: The printable character that byte-level vocabularies write for each byte.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
PRINTED = {b: b for b in _PRINTED} | {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _PRINTED)}


class Words(dict):
    """Ids of a word as little-endian 32-bit bytes, encoded when first met."""

    def __init__(self, tokenizer: Tokenizer) -> None:
        super().__init__()
        self.model, self.older = tokenizer.model, {}

    def __missing__(self, word: str) -> bytes:
        found = self.older.pop(word, None)
        if found is None:
            printed = word.encode().decode("latin-1").translate(PRINTED)
            found = struct.pack(f"<{len(ids := [t.id for t in self.model.tokenize(printed)])}I", *ids)
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        self[word] = found
        return found


class Encoder:
    """Texts to ids, exactly as the tokenizer file has it; no special tokens are added.

    With ``plain`` the strings of special tokens inside a text are ordinary text.
    """

    def __init__(self, path: str, plain: bool = False) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        self.words = Words(self.tokenizer)
        normalizer, splitting = self.tokenizer.normalizer, str(self.tokenizer.pre_tokenizer)
        self.fold = normalizer is not None
        self.pattern = None  # another kind of tokenizer: always the library itself
        if normalizer is None and splitting == BYTE_SPLIT:
            self.pattern = BYTE_WORDS
        elif "Lowercase()" in str(normalizer) and LOWER_SPLIT in splitting.replace("\\\\", "\\"):
            self.pattern = LOWER_WORDS

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if self.pattern is None or "<|" in text or not PLAIN.fullmatch(text):
            return self.encode_whole(text)
        return b"".join(map(self.words.__getitem__, self.pattern.findall(text.lower() if self.fold else text)))

    def encode_whole(self, text: str) -> bytes:
        """The same ids from the library alone, which is quicker for words not met before."""
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4").tobytes()

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (null: empty) one after the other, and where each text's begin.

        A byte-level tokenizer always ends a token before a space or a line feed that follows another character,
        so each distinct stretch between such places is encoded once. Other texts are encoded one by one.
        """
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        data, limits = buffers(texts)
        if self.pattern is not BYTE_WORDS or not len(data):
            found = [self.encode(x) for x in texts.to_pylist()]
            return np.frombuffer(b"".join(found), "<u4"), np.r_[0, np.cumsum([len(x) // 4 for x in found], dtype=np.int64)]
        first = np.zeros(len(data) + 1, bool)
        first[stretch_starts(data)] = True
        # a text that may hold a special token is one stretch, which the library gets as it is
        for k in np.flatnonzero(pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False)).tolist():
            first[limits[k] : limits[k + 1]] = False
        first[limits] = True
        starts = np.flatnonzero(first)
        coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts) - 1, [None, pa.py_buffer(starts), pa.py_buffer(data)]).dictionary_encode()
        codes = coded.indices.to_numpy()
        lists = self.encode_stretches(coded.dictionary)
        sizes = np.r_[0, np.cumsum(np.diff(lists.offsets.to_numpy())[codes], dtype=np.int64)]
        return lists.take(pa.array(codes)).values.to_numpy(), sizes[np.searchsorted(starts, limits)]

    def encode_stretches(self, stretches: pa.LargeBinaryArray) -> pa.LargeListArray:
        """Ids of distinct stretches; plain ones that start at a certain cut and end in no white space as one run of text."""
        data, limits = buffers(stretches)
        bad = ~PLAIN_BYTES[data]
        bad[1:] |= (data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7))  # the two signs among the letters
        joined = (np.add.reduceat(bad, limits[:-1], dtype=np.int64) == 0) & ~WHITE[data[limits[1:] - 1]] & np.isin(data[limits[:-1]], [10, 32])
        joined &= ~pc.match_substring(stretches.cast(pa.large_string()), "<|").to_numpy(zero_copy_only=False) & (self.quick is not None)
        rest = np.flatnonzero(~joined)
        ids = [np.frombuffer(self.encode(x.decode()), "<u4") for x in stretches.take(pa.array(rest)).to_pylist()]
        run, run_limits = buffers(stretches.filter(pa.array(joined)))
        found = self.quick.encode_to_numpy(run.tobytes().decode(), disallowed_special=()) if len(run) else np.zeros(0, np.uint32)
        sizes = np.empty(len(stretches), np.int64)
        sizes[rest] = [len(x) for x in ids]
        sizes[joined] = np.diff(np.searchsorted(np.cumsum(self.widths[found]), run_limits, "right"))
        values = np.empty(int(sizes.sum()), np.uint32)
        values[np.repeat(joined, sizes)] = found
        values[np.repeat(~joined, sizes)] = np.concatenate([*ids, np.zeros(0, np.uint32)])
        return pa.LargeListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)]), pa.array(values))

    @cached_property
    def quick(self) -> tiktoken.Encoding | None:
        return self.ranked()

    @cached_property
    def widths(self) -> np.ndarray:
        """Bytes of each id."""
        return np.array([len(x) for x in self.byte_table()])

    def byte_table(self) -> list[bytes]:
        """Bytes of each id of a byte-level vocabulary; a special token's are those of its string."""
        shown = {chr(c): byte for byte, c in PRINTED.items()}
        names = [self.tokenizer.id_to_token(k) or "" for k in range(self.tokenizer.get_vocab_size())]
        return [bytes(shown[c] for c in n) if all(c in shown for c in n) else n.encode() for n in names]

    def ranked(self) -> tiktoken.Encoding | None:
        """The same merges by the quicker tiktoken library, where ids follow the order of the merges; for plain texts."""
        model = json.loads(self.tokenizer.to_str())["model"]
        merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        if self.pattern is not BYTE_WORDS or any(b <= a for a, b in itertools.pairwise(merged)):
            return None
        special = self.tokenizer.get_added_tokens_decoder()
        ranks = {x: k for k, x in enumerate(self.byte_table()) if k not in special}
        return tiktoken.Encoding("ranked", pat_str=BYTE_PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=4)
def encoder(path: str, plain: bool = False) -> Encoder:
    """The encoder of this Python worker, kept from task to task."""
    return Encoder(path, plain)
