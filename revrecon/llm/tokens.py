"""Token ids of whole texts, with the tokenizers library and a vocabulary file whose path is a parameter.

Pre-tokens of the vocabulary never cross a space or a line feed, and it lower-cases, so a text's ids are the ids of its
lower-cased chunks between those two, one after another; marks that end a word are a chunk of their own.
Each worker keeps the ids of the last ``KEPT`` to twice as many chunks it has met, and asks the library only for others. Texts
that hold the opening of a special token go to the library whole.
"""

from __future__ import annotations

import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import WhitespaceSplit

from revrecon.llm.common import held, quiet_threads

KEPT = 350_000
#: Words that go to the library as one text; its time for a word grows in longer ones.
TOGETHER = 128
VOCABULARY = "word_bpe_49k.json"
#: A run of ASCII marks that ends a word is a pre-token of its own; after other bytes it may belong to a longer run.
TAIL = re.compile(rb"([!-/:-@\[-`{-~](?<=[a-z].)[!-/:-@\[-`{-~]*)(?= )")
WIDE_TAIL = re.compile(rb"([!-/:-@\[-`{-~](?<=[a-z0-9\x80-\xff].)[!-/:-@\[-`{-~]*)(?= )")
#: What stands before a mark: letters and digits, blanks, stops and commas, other marks.
KINDS = bytes(
    ord("a") if b >= 128 or chr(b) in "abcdefghijklmnopqrstuvwxyz0123456789" else 32 if b == 32 else ord("p") if chr(b) in ".," else ord("q")
    for b in range(256)
)
#: Bytes of ASCII and of U+00C0 to U+00FF, which are letters but for two signs.
LATIN, SIGNS = bytes([*range(128), 0xC3, *range(0x80, 0xC0)]), (b"\xc3\x97", b"\xc3\xb7")


def vocabulary_path(name: str = VOCABULARY) -> str:
    return public_tokenizers.path(name)


def spaced(text: str) -> bytes:
    """The text lower-cased, its chunks parted by single spaces."""
    b = text.encode("utf-8", "surrogatepass").lower().replace(b"\n", b" ")
    if b.translate(None, LATIN) or any(sign in b for sign in SIGNS):
        return TAIL.sub(rb" \1", b)
    kinds = b.translate(KINDS)
    if b"q " in kinds or b"pp " in kinds or b"qp " in kinds:
        return WIDE_TAIL.sub(rb" \1", b)
    return b.replace(b". ", b" . ").replace(b", ", b" , ")


class TokenReader:
    def __init__(self, path: str):
        quiet_threads()
        self.library = Tokenizer.from_file(path)
        self.size = self.library.get_vocab_size(with_added_tokens=True)
        self.kind = np.dtype("<u2") if self.size <= 1 << 16 else np.dtype("<u4")
        self.ends = np.zeros(self.size, bool)
        for token, i in self.library.get_vocab().items():
            self.ends[i] = token.endswith("</w>")
        self.bare = self.bare_library()
        self.known: dict[bytes, bytes] = {b"": b""}
        self.older: dict[bytes, bytes] = {}

    def bare_library(self) -> Tokenizer:
        """The vocabulary's model alone, for words of a to z, where it gives the same ids; else the whole library."""
        bare = Tokenizer(self.library.model)
        bare.pre_tokenizer = WhitespaceSplit()
        probe = " ".join([t for t in sorted(self.library.get_vocab()) if t.isascii() and t.isalpha() and t.islower()][::16])
        return bare if np.array_equal(self.whole([probe], bare), self.whole([probe])) else self.library

    def whole(self, texts: list[str], library: Tokenizer | None = None) -> list[np.ndarray]:
        read = (library or self.library).encode_batch_fast
        return [np.array(e.ids, self.kind) for e in read(texts, add_special_tokens=False)]

    def learn(self, fresh: list[bytes]) -> None:
        """Ids of new chunks. Plain words go together, cut where a token ends a word; others one by one."""
        plain, wide, others = [], [], []
        for chunk in fresh:
            if chunk.isalpha():
                plain.append(chunk)
                continue
            text = chunk.decode("utf-8", "replace")
            (wide if text.isalpha() and text == text.lower() else others).append(chunk)
        for library, words in ((self.bare, plain), (self.library, wide)):
            for lo in range(0, len(words), TOGETHER):
                part = words[lo : lo + TOGETHER]
                ids = self.whole([b" ".join(part).decode()], library)[0]
                cuts = np.flatnonzero(self.ends[ids]) + 1
                if len(cuts) != len(part):
                    others += part
                    continue
                raw, width = ids.tobytes(), self.kind.itemsize
                edges = [0, *(cuts * width).tolist()]
                self.known.update((c, raw[a:b]) for c, a, b in zip(part, edges[:-1], edges[1:], strict=True))
        for lo in range(0, len(others), 20_000):
            part = others[lo : lo + 20_000]
            ids = self.whole([c.decode("utf-8", "replace") for c in part])
            self.known.update((c, i.tobytes()) for c, i in zip(part, ids, strict=True))

    def ids_of(self, met: list[bytes]) -> list[bytes]:
        """The ids of different chunks, asked of the library for those that are not kept."""
        found = [self.known.get(c) for c in met]
        fresh = [c for c, ids in zip(met, found, strict=True) if ids is None]
        if len(self.known) + len(fresh) > KEPT:
            self.older, self.known = self.known, {b"": b""}
        again = {c: self.older[c] for c in fresh if c in self.older}
        self.known.update(again)
        self.learn([c for c in fresh if c not in again])
        return [self.known[c] if ids is None else ids for c, ids in zip(met, found, strict=True)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text as little-endian unsigned numbers of ``self.kind``.

        Each different chunk of the texts is looked up once; its ids are then laid down wherever it stands.
        """
        plain = pa.array([spaced(t) for t in texts if "<|" not in t], pa.large_binary())
        chunks = pc.split_pattern(plain, b" ")
        coded = chunks.flatten().dictionary_encode()
        met = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = pa.array(self.ids_of(met), pa.large_binary()).take(coded.indices)
        sizes = pc.binary_length(ids).to_numpy(zero_copy_only=False) // self.kind.itemsize
        edges = np.append(0, np.cumsum(sizes))[chunks.offsets.to_numpy()].tolist()
        flat = np.frombuffer(ids.buffers()[2] if edges[-1] else b"", self.kind, edges[-1])
        done = iter([flat[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)])
        return [next(done) if "<|" not in t else self.whole([t])[0] for t in texts]


def reader(path: str) -> TokenReader:
    """This worker's reader of a vocabulary file; it outlives the task, until another operator runs in the worker."""
    readers = held("tokens")
    if path not in readers:
        readers[path] = TokenReader(path)
    return readers[path]
