"""BPE encoding and decoding by forced boundaries.

Two neighbouring bytes that stand next to each other inside no token of the
vocabulary can never be merged across: between them every encoding has a cut,
whatever stands around.  So a text falls into fragments that are encoded
independently, each once, and their ids concatenated.  Space bytes stand in no
token of a vocabulary that drops white space, which cuts the text at every
ASCII white space (there also normalisation and word splitting start anew);
inside a word the table of byte pairs cuts further, so that a run of millions
of letters is merged in short pieces.

The file of the ``tokenizers`` library gives the vocabulary, the merges and the
rules of normalisation and word splitting; the merging is done here.
"""

from __future__ import annotations

import gc
import heapq
import json
import re
import string
from collections.abc import Callable
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clickscope.llm.common import WHITE, shipped

#: A tokenizer file is sent to all tasks; larger ones are refused.
MOST_FILE_BYTES = 64 << 20
# remembered chunks and words of a task, the longest one remembered, and the chunks looked at together
_MEMO, _MEMO_BYTES, _SLICE = 400_000, 64, 1 << 18
_MARK = "\U0010FFFD"  # a private character that stands between chunks split together
_NEVER = 1 << 30
_LONG = 64             # symbols from which a fragment is merged by a queue
# Fixed value: characters that stand alone in normal form C and whose class is settled; there normalisation is lower-casing.
_SETTLED = re.compile("[!-~\u00a1-\u02ff]+")
_PLAIN_NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]


def _byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in plain)}
    return [moved.get(b, chr(b)) for b in range(256)]


class Encoder:
    """Encodes and decodes with one tokenizer file."""

    def __init__(self, file: str):
        spec = json.loads(file)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self._suffix = model.get("end_of_word_suffix") or ""
        alphabet = _byte_alphabet()
        self._check(spec, vocab, alphabet)
        self._first = [np.array([vocab[c + end] for c in alphabet]) for end in ("", self._suffix)]
        merges = [(vocab[a], vocab[b], vocab[a + b]) for a, b in (m.split(" ") if isinstance(m, str) else m for m in model["merges"])]
        left, right, both = np.array(merges, dtype=np.int64).reshape(-1, 3).T
        self._product, pairs = both, left << 32 | right
        self._rank_of_pair = np.argsort(pairs, kind="stable")
        self._pairs_in_order = pairs[self._rank_of_pair]
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in [*vocab.items(), *added.items()]}
        self._token_of = np.full(max(self.tokens) + 1, None, dtype=object)
        self._token_of[list(self.tokens)] = list(self.tokens.values())
        self._added = {t: np.array([i], dtype="<u4").tobytes() for t, i in added.items()}
        self._added_bytes = [t.encode() for t in added]
        self._at_added = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self._to_byte = {ord(c): b for b, c in enumerate(alphabet)}
        self.inside = self._pairs(vocab)
        rules = Tokenizer.from_str(json.dumps(spec | {"model": {"type": "BPE", "vocab": {}, "merges": []}, "added_tokens": []}))
        self._normalizer, self._splitter = rules.normalizer, rules.pre_tokenizer
        if self._split("a" + WHITE + "b") != self._split("a") + self._split("b"):
            raise ValueError("a tokenizer that keeps white space is not supported")
        self._mark = self._split(_MARK)[0]
        self._settled_words = self._pattern(spec)
        self._chunks: dict[bytes, bytes] = {}
        self._words: dict[bytes, bytes] = {}

    def _check(self, spec: dict, vocab: dict[str, int], alphabet: list[str]) -> None:
        model = spec["model"]
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges") if model.get(k)]
        odd += [t["content"] for t in spec["added_tokens"] if t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"]
                or not t["content"] or any(c in WHITE for c in t["content"])]
        if model["type"] != "BPE" or odd or spec["decoder"] or spec["post_processor"]:
            raise ValueError(f"not supported in a tokenizer file: {odd or 'its model, decoder or post-processor'}")
        if any(c + end not in vocab for c in alphabet for end in ("", self._suffix)):
            raise ValueError("the vocabulary lacks single bytes")

    def _pattern(self, spec: dict) -> Callable[[str], list[str]] | None:
        """The file's pattern of words, if settled characters need nothing else than it (None: they go the general way)."""
        steps = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        if (spec["normalizer"] or {}).get("normalizers") != _PLAIN_NORMALIZER or [s["type"] for s in steps] != ["Split", "ByteLevel"]:
            return None
        split, level = steps
        plain = split["behavior"] == "Removed" and split["invert"] and not level["add_prefix_space"] and not level["use_regex"]
        find = regex.compile(split["pattern"]["Regex"]).findall if plain and "Regex" in split["pattern"] else None
        return find if find and find(string.ascii_lowercase) == [string.ascii_lowercase] else None

    def _pairs(self, vocab: dict[str, int]) -> np.ndarray:
        """Which byte pairs stand side by side inside a token."""
        inside = np.zeros((256, 256), dtype=bool)
        for token in vocab:
            own = token.removesuffix(self._suffix) if self._suffix else token
            own = [self._to_byte[ord(c)] for c in own if ord(c) in self._to_byte]
            inside[own[:-1], own[1:]] = True
        return inside

    def _split(self, text: str) -> list[bytes]:
        """Words of a text by the library's rules."""
        if self._normalizer:
            text = self._normalizer.normalize_str(text)
        return [w.translate(self._to_byte).encode("latin-1") for w, _ in self._splitter.pre_tokenize_str(text)]

    # ------------------------------------------------------------ merging
    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if not len(self._pairs_in_order):
            return np.full(len(left), _NEVER)
        pair = left << 32 | right
        at = np.minimum(np.searchsorted(self._pairs_in_order, pair), len(self._pairs_in_order) - 1)
        return np.where(self._pairs_in_order[at] == pair, self._rank_of_pair[at], _NEVER)

    def fragments(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """First symbols of the words' bytes, side by side, and which of them begin a fragment."""
        raw = np.frombuffer(b"".join(words), dtype=np.uint8)
        end = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)))
        ids = self._first[0][raw]
        ids[end - 1] = self._first[1][raw[end - 1]]
        begins = np.ones(len(raw), dtype=bool)
        begins[1:] = ~self.inside[raw[:-1], raw[1:]]
        begins[end[:-1]] = True
        return ids, begins

    def merged(self, ids: np.ndarray, begins: np.ndarray, long: int = _LONG) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all fragments, each merged on its own, and the place of each id's first symbol.

        In a fragment the pair of lowest rank is merged first, the leftmost of
        equals; a round does that for all fragments at once.
        """
        first = np.flatnonzero(begins)
        size = np.diff(np.append(first, len(ids)))
        done_ids, done_at = [], []
        for f in np.flatnonzero(size >= long).tolist():
            got, at = self._merged_by_queue(ids[first[f]: first[f] + size[f]].tolist())
            done_ids.append(np.array(got, dtype=np.int64))
            done_at.append(np.array(at, dtype=np.int64) + first[f])
        at = np.flatnonzero(np.repeat(size < long, size))
        ids, begins = ids[at], begins[at]
        rank = np.full(len(ids), _NEVER)  # of the symbol and the next one of its fragment
        inner = np.flatnonzero(~begins) - 1
        rank[inner] = self._ranks(ids[inner], ids[inner + 1])
        while len(ids):
            first = np.flatnonzero(begins)
            size = np.diff(np.append(first, len(ids)))
            least = np.minimum.reduceat(rank, first)
            open_ = np.repeat(least < _NEVER, size)
            done_ids.append(ids[~open_])
            done_at.append(at[~open_])
            low = np.repeat(least, size)[open_]
            ids, at, begins, rank = ids[open_], at[open_], begins[open_], rank[open_]
            hit = rank == low
            # equal neighbours overlap: every other one of a run is merged, from its left end
            run = np.flatnonzero(hit & ~np.concatenate(([False], hit[:-1])))
            place = np.flatnonzero(hit)
            place = place[(place - run[np.searchsorted(run, place, "right") - 1]) % 2 == 0]
            ids[place] = self._product[rank[place]]
            stay = np.ones(len(ids), dtype=bool)
            stay[place + 1] = False
            new = np.zeros(len(ids), dtype=bool)
            new[place] = True
            ids, at, begins, rank, new = ids[stay], at[stay], begins[stay], rank[stay], new[stay]
            new[:-1] |= new[1:]
            last = np.append(begins[1:], True)
            again = np.flatnonzero(new & ~last)
            rank[new] = _NEVER
            rank[again] = self._ranks(ids[again], ids[again + 1])
        ids, at = np.concatenate([np.zeros(0, np.int64), *done_ids]), np.concatenate([np.zeros(0, np.int64), *done_at])
        order = np.argsort(at, kind="stable")
        return ids[order], at[order]

    def _merged_by_queue(self, ids: list[int]) -> tuple[list[int], list[int]]:
        """The same for one long fragment, in n log n steps."""
        after, before = [*range(1, len(ids) + 1)], [*range(-1, len(ids) - 1)]
        known: dict[tuple[int, int], int] = {}

        def rank(left: int, right: int) -> int:
            if (left, right) not in known:
                known[left, right] = int(self._ranks(np.array([left]), np.array([right]))[0])
            return known[left, right]
        queue: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < len(ids) and (found := rank(ids[i], ids[j])) < _NEVER:
                heapq.heappush(queue, (found, i, ids[i], ids[j]))

        for i in range(len(ids) - 1):
            offer(i)
        while queue:
            best, i, left, right = heapq.heappop(queue)
            j = after[i]
            if ids[i] != left or j >= len(ids) or ids[j] != right:
                continue  # one of the two has been merged since
            ids[i], ids[j] = int(self._product[best]), -1
            after[i] = after[j]
            if after[i] < len(ids):
                before[after[i]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        at = [i for i, x in enumerate(ids) if x >= 0]
        return [ids[i] for i in at], at

    # ------------------------------------------------------------ texts
    def _learn_words(self, words: list[bytes]) -> None:
        if not words:
            return
        ids, at = self.merged(*self.fragments(words))
        end = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)))
        cut = [0, *(4 * np.searchsorted(at, end)).tolist()]
        packed = ids.astype("<u4").tobytes()
        self._words.update(zip(words, (packed[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)), strict=True))

    def _words_of(self, chunks: list[bytes]) -> list[list[bytes]]:
        """The words of each of some texts without ASCII white space and added tokens."""
        out: list[list[bytes]] = [[]] * len(chunks)
        odd = []
        find, settled = self._settled_words, _SETTLED.fullmatch
        for n, chunk in enumerate(chunks):
            if find and chunk.isalpha():  # ASCII letters
                out[n] = [chunk.lower()]
                continue
            text = chunk.decode()
            if find and settled(text):
                out[n] = [w.encode() for w in find(text.lower())]
            elif _MARK in text:
                out[n] = self._split(text)
            else:
                odd.append((n, text))
        if odd:
            at = 0
            for n, _ in odd:
                out[n] = []
            for word in self._split(f" {_MARK} ".join(t for _, t in odd)):
                if word == self._mark:
                    at += 1
                else:
                    out[odd[at][0]].append(word)
        return out

    def _learn(self, chunks: set[bytes]) -> None:
        """Ids of these chunks, put into the memo."""
        if len(self._words) > _MEMO:
            self._words.clear()
        plain, all_chunks = list(chunks), b" ".join(chunks)
        if any(t in all_chunks for t in self._added_bytes):
            plain = [c for c in chunks if not any(t in c for t in self._added_bytes)]
        parts = {c: [p for p in self._at_added.split(c.decode()) if p] for c in chunks.difference(plain)} if len(plain) < len(chunks) else {}
        between = [p.encode() for own in parts.values() for p in own if p not in self._added]
        words = self._words_of(plain + between)
        new = list(set(chain.from_iterable(words)).difference(self._words))
        self._learn_words(new)
        id_of = self._words.__getitem__
        ids = [id_of(own[0]) if len(own) == 1 else b"".join(map(id_of, own)) for own in words]
        for w in new:
            if len(w) > _MEMO_BYTES:
                del self._words[w]
        self._chunks.update(zip(plain, ids[: len(plain)], strict=True))
        rest = iter(ids[len(plain):])
        for c, own in parts.items():
            self._chunks[c] = b"".join(self._added[p] if p in self._added else next(rest) for p in own)

    def encode_all(self, texts: list[bytes | None]) -> list[bytes]:
        """Ids of UTF-8 texts as little-endian unsigned 32-bit integers; new chunks of many texts are learned together."""
        collecting = gc.isenabled()
        gc.disable()  # many small lists and no cycles
        try:
            return self._encode_all(texts)
        finally:
            if collecting:
                gc.enable()

    def _encode_all(self, texts: list[bytes | None]) -> list[bytes]:
        out: list[bytes] = []
        ready: list[list[bytes]] = []
        waiting = 0
        for text in texts:
            chunks = (text or b"").split()
            if len(chunks) >= _SLICE:
                out += self._joined(ready)
                ready, waiting = [], 0
                out.append(b"".join(self._joined([chunks[at: at + _SLICE] for at in range(0, len(chunks), _SLICE)], together=1)))
                continue
            ready.append(chunks)
            waiting += len(chunks)
            if waiting >= _SLICE:
                out += self._joined(ready)
                ready, waiting = [], 0
        return out + self._joined(ready)

    def _joined(self, lists: list[list[bytes]], together: int | None = None) -> list[bytes]:
        out: list[bytes] = []
        for at in range(0, len(lists), together or max(1, len(lists))):
            part = lists[at: at + (together or len(lists))]
            if len(self._chunks) > _MEMO:
                self._chunks.clear()
            new = set().union(*part).difference(self._chunks)
            if new:
                self._learn(new)
            out += [b"".join(map(self._chunks.__getitem__, own)) for own in part]
            for c in new:
                if len(c) > _MEMO_BYTES:
                    del self._chunks[c]
        return out

    def encode(self, text: bytes | None) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, ids: bytes | None) -> str:
        """The tokens' strings joined by a space: what the library gives for a file without a decoder."""
        return " ".join(self._token_of[np.frombuffer(ids or b"", dtype="<u4")].tolist())


def encoder(spark: SparkSession, path: str) -> Callable[[], Encoder]:
    """The encoder of a tokenizer file on the driver, for tasks; files over ``MOST_FILE_BYTES`` are refused."""
    file = Path(path)
    if file.stat().st_size > MOST_FILE_BYTES:
        raise ValueError(f"{path} is larger than {MOST_FILE_BYTES} bytes")
    text = file.read_text(encoding="utf-8")
    Encoder(text)  # a file that is not supported fails here, not in tasks
    text_of, made = shipped(spark, text), []

    def encoder_of() -> Encoder:
        if not made:
            made.append(Encoder(text_of()))
        return made[0]
    return encoder_of


def encode(text: Column, encoder_of: Callable[[], Encoder]) -> Column:
    """Token ids of a column of whole texts, packed as little-endian unsigned 32-bit integers.

    Strings of added tokens in a text become those tokens; none is put before
    or after.  Null, empty and blank texts have no ids.  A task holds one text
    and its ids at a time besides its batch, whatever the text's length.
    """
    @F.arrow_udf("binary")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array(encoder_of().encode_all(texts.cast(pa.large_binary()).to_pylist()), pa.binary())
    return of(text)


def decode(ids: Column, encoder_of: Callable[[], Encoder]) -> Column:
    """Texts of a column of packed token ids, special tokens included (null or no ids: empty)."""
    @F.arrow_udf("string")
    def of(packed: pa.Array) -> pa.Array:
        enc = encoder_of()
        return pa.array([enc.decode(p.as_py()) for p in packed], pa.string())
    return of(ids)


def id_count(ids: Column) -> Column:
    """How many ids a packed column holds."""
    return F.floor(F.coalesce(F.octet_length(ids), F.lit(0)) / 4).cast("long")
