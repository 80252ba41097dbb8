"""Byte-pair encoding by backtracking, and decoding by an offset table.

The tokenizer file is a published one in the JSON form of the `tokenizers` library: NFC, white space made equal, lower
case, a split into letters, single digits and signs, bytes as printable characters, and merges with word ends.

Encoding a word: an Aho-Corasick automaton of all tokens gives the longest token at every position in one pass. The
encoder takes the longest token that is compatible with the one before (a table of merges and of each token's two halves
tells whether the merges would join or cut the pair in another way), falls back to the next shorter prefix, and steps
back where none is left; a position that failed is never tried again, so the time is linear. A sequence whose adjacent
pairs are all compatible is the one that the merges give.

The backtracking over longest matches and the test of a pair (undo the later of two merges until their halves meet) are a
published scheme: that of the `bpe` crate in GitHub's rust-gems (MIT licence); the tables, caches, splitting and decoding here are its own.
"""

from __future__ import annotations

import json
import sys
import types
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T

from gridtide.llm import words as W

CACHE_ENTRIES = 200_000
# Of the tokenizer's own definition (fixed values): its split pattern, and the characters that it counts as white space.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SPACES = "\t\n\x0b\x0c\r \x85\xa0  -     　"
END = "</w>"


def per_process(key: str, make):
    """One value per Python worker. Task functions travel by value, so module variables start anew with every task."""
    kept = sys.modules.setdefault("_gridtide_kept", types.ModuleType("_gridtide_kept")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]


def byte_characters() -> str:
    """The printable character for each byte: itself where printable in Latin-1, else the next free one from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return "".join(chr(b if b in own else next(free)) for b in range(256))


class Bpe:
    def __init__(self, spec: str):
        import ahocorasick
        import regex

        spec = json.loads(spec)
        model, self.special = spec["model"], {x["content"]: x["id"] for x in spec["added_tokens"]}
        if model["end_of_word_suffix"] != END or model["continuing_subword_prefix"] or spec["decoder"]:
            raise ValueError("Only byte-pair models with word ends and without a decoder can be read.")
        vocab = model["vocab"]
        self.size = max([*vocab.values(), *self.special.values()]) + 1
        self.bytes_to_text = {i: c for i, c in enumerate(byte_characters())}
        self.halves = [(i, i) for i in range(self.size)]  # a single character is its own halves
        self.rank = list(range(self.size))
        self.pairs: dict[tuple[int, int], int] = {}
        for r, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            joined = vocab[a + b]
            self.pairs[vocab[a], vocab[b]] = joined
            self.halves[joined] = vocab[a], vocab[b]
            if joined != len(vocab) - len(model["merges"]) + r:
                raise ValueError("Token numbers must follow the order of the merges.")
        # Inside the automaton the word end is one character, which is in no word.
        self.texts = {i: t[: -len(END)] + "\0" if t.endswith(END) and len(t) > len(END) else t for t, i in vocab.items()}
        numbers = {t: i for i, t in self.texts.items()}
        self.automaton = ahocorasick.Automaton()
        for text, i in numbers.items():
            self.automaton.add_word(text, (i, len(text)))
        self.automaton.make_automaton()
        self.length = [0] * self.size
        self.shorter = [-1] * self.size
        for i, text in self.texts.items():
            self.length[i] = len(text)
            self.shorter[i] = next((numbers[text[:n]] for n in range(len(text) - 1, 0, -1) if text[:n] in numbers), -1)
        self.split = regex.compile(SPLIT).findall
        self.space_split = regex.compile(f"[^{SPACES}]+").findall
        self.odd_space = regex.compile("[\x1c-\x1f]").search
        self.special_split = regex.compile("(" + "|".join(regex.escape(x) for x in self.special) + ")").split if self.special else None
        # Three bounded caches; a full one starts anew.
        self.cache: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.agree: dict[int, bool] = {}
        shown = {i: t for t, i in (vocab | self.special).items()}
        pieces = [(" " + shown.get(i, "")).encode() for i in range(self.size)]
        self.blob = np.frombuffer(b"".join(pieces), np.uint8)
        self.offsets = np.r_[0, np.cumsum([len(p) for p in pieces])]

    def compatible(self, a: int, b: int) -> bool:
        """Whether the merges, run on the text of a and b together, give just a and b."""
        limit = self.size
        while True:
            joined = self.pairs.get((a, b))
            if joined is not None and joined < limit:
                return False
            if a > b:  # a was made later, so before that its right half stood next to b
                limit, a = a, self.halves[a][1]
                if a == limit:
                    limit, b = b + 1, self.halves[b][0]
                    if b + 1 == limit:
                        return True
            else:
                limit, b = b + 1, self.halves[b][0]
                if b + 1 == limit:
                    limit, a = a, self.halves[a][1]
                    if a == limit:
                        return True

    def word(self, text: str) -> list[int]:
        """Tokens of one word of the split, given as the printable characters of its bytes."""
        text += "\0"
        size, length, shorter, agree = len(text), self.length, self.shorter, self.agree
        longest = [-1] * (size + 1)
        for end, (token, n) in self.automaton.iter(text):
            longest[end - n + 1] = token  # ends rise, so the longest comes last
        out: list[int] = []
        dead = bytearray(size + 1)
        at, token = 0, longest[0]
        while at < size:
            while token >= 0:
                if not dead[at + length[token]]:
                    if not out:
                        break
                    pair = out[-1] * self.size + token
                    fits = agree.get(pair)
                    if fits is None:
                        fits = agree[pair] = self.compatible(out[-1], token)
                    if fits:
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at += length[token]
                token = longest[at]
            else:
                dead[at] = 1
                token = out.pop()
                at -= length[token]
        if len(agree) >= CACHE_ENTRIES:
            agree.clear()
        return out

    def run(self, text: str) -> bytes:
        """Tokens, as 32-bit numbers, of one run of text without white space."""
        found = self.cache.get(text)
        if found is None:
            pieces = []
            for piece in self.split(text):
                tokens = self.words.get(piece)
                if tokens is None:
                    tokens = array("i", self.word(piece.encode().decode("latin-1").translate(self.bytes_to_text))).tobytes()
                    if len(self.words) >= CACHE_ENTRIES:
                        self.words.clear()
                    self.words[piece] = tokens
                pieces.append(tokens)
            found = b"".join(pieces)
            if len(self.cache) >= CACHE_ENTRIES:
                self.cache.clear()
            self.cache[text] = found
        return found

    def encode(self, text: str) -> np.ndarray:
        parts = self.special_split(text) if self.special_split and "<" in text else [text]
        out = []
        for i, part in enumerate(parts):
            if i % 2:
                out.append(np.int32(self.special[part]).tobytes())
                continue
            if not part.isascii():
                part = unicodedata.normalize("NFC", part)
                if "Σ" in part:  # the tokenizer lower-cases one character at a time
                    part = part.replace("Σ", "σ")
            part = part.lower()
            get, run = self.cache.get, self.run
            for x in self.space_split(part) if self.odd_space(part) else part.split():
                out.append(get(x) or run(x))
        return np.frombuffer(b"".join(out), np.int32)

    def decode(self, ids: np.ndarray) -> bytes:
        """The tokens' texts joined by one space, copied from one table of all token texts."""
        sizes = self.offsets[ids + 1] - self.offsets[ids]
        ends = np.cumsum(sizes)
        take = np.repeat(self.offsets[ids] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
        return self.blob[take].tobytes()[1:]


def read_spec(path: str | None = None) -> str:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode(docs: DataFrame, text: str = "text", path: str | None = None, ids: str = "token_ids", decoded: str | None = None) -> DataFrame:
    """All columns of `docs`, then `ids` (array<int>) and, if named, `decoded`: the text that the tokens give back.

    Null and empty texts give no tokens. The strings of special tokens in a text are those tokens. Rows are independent
    of each other; a result column replaces one of the same name. `path`: the tokenizer's JSON file, read by the driver
    and sent to the tasks (a file of fixed size).
    """
    spec = docs.sparkSession.sparkContext.broadcast(read_spec(path))
    docs = docs.drop(ids, decoded) if decoded else docs.drop(ids)
    fields = docs.schema.fields + [T.StructField(ids, T.ArrayType(T.IntegerType()))]
    if decoded:
        fields.append(T.StructField(decoded, T.StringType()))

    def run(batches):
        bpe = per_process(f"bpe {hash(spec.value)}", lambda: Bpe(spec.value))
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            for lo, hi, _, _ in W.text_blocks(texts):
                part = pa.Table.from_batches([batch.slice(lo, hi - lo)])
                found = [bpe.encode(x or "") for x in texts.slice(lo, hi - lo).to_pylist()]
                offsets = pa.array(np.r_[0, np.cumsum([len(x) for x in found])].astype(np.int32))
                part = part.append_column(ids, pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(found))))
                if decoded:
                    part = part.append_column(decoded, pa.array([bpe.decode(x).decode() for x in found], pa.string()))
                yield from part.to_batches()

    return docs.mapInArrow(run, T.StructType(fields))


def decode(tokens: DataFrame, ids: str = "token_ids", decoded: str = "decoded_text", path: str | None = None) -> DataFrame:
    """All columns of `tokens`, then the text of the token numbers in `ids`; null gives empty text."""
    spec = tokens.sparkSession.sparkContext.broadcast(read_spec(path))
    tokens = tokens.drop(decoded)

    def run(batches):
        bpe = per_process(f"bpe {hash(spec.value)}", lambda: Bpe(spec.value))
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                part = batch.slice(lo, 200)
                lists = part.column(part.schema.get_field_index(ids)).to_pylist()
                texts = [bpe.decode(np.array(x or [], np.int64)).decode() for x in lists]
                yield from pa.Table.from_batches([part]).append_column(decoded, pa.array(texts, pa.string())).to_batches()

    return tokens.mapInArrow(run, T.StructType(tokens.schema.fields + [T.StructField(decoded, T.StringType())]))
