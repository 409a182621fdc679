"""Byte-level BPE as a streaming transducer with bounded lookahead, and the way back.

*Lookahead.* Compare the merges of a text with and without more text after it.  Both agree left of a frontier, at
first the text's end.  Only a merge across the frontier that happens in one of the two moves it, by the length of the
merge's left part ``u``; the next merge to cross it has a lower rank in the list and a right part that begins
with ``u``.  The longest such chain, weighted by the lengths of the left parts, is found in one pass from the last
merge to the first.  Tokens that end this many bytes before the end of what has been read are final
(``Vocabulary.lookahead``), so a run of any length is encoded in a window of constant size: see ``RunEncoder``.

*Words.* Merges never cross the pre-tokenizer's pieces, and a single space or line feed between two characters that are
not white space always begins a piece.  Texts are cut there and the parts are remembered in a table of
bounded size; parts without such a place go through the pre-tokenizer's pattern, itself applied in blocks.

*Decoding.* Ids give bytes, bytes go through an incremental UTF-8 decoder which keeps at most three bytes between blocks.

Defined cases: a null text is the empty text and has no tokens; special tokens of the vocabulary that occur in a
text become their own id, as in the library the file is made for; repeated rows and equal ids are encoded one by one;
an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
from array import array
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from revmart.llm.common import text_of

#: Fixed value: the published pre-tokenizer pattern of byte-level BPE.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: White space and control characters other than space and line feed: texts with them take the pattern's way.
ODD_SPACE = re.compile("[\x00-\x09\x0b-\x1f\x7f-\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f\u3000\ufeff]|  |\n\n| \n|\n ")
BLOCK = 1 << 16  # characters read at a time
WINDOW = 1024  # bytes of a run that are merged at a time, besides the lookahead
REMEMBERED = 1 << 18  # parts remembered per worker
NONE = 1 << 62
FOREVER = 1 << 40  # beyond any rank


def byte_letters() -> dict[str, int]:
    """Letters that stand for bytes in byte-level vocabularies: printable Latin-1 as it is, others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Merges and tokens of a byte-level BPE file in the JSON layout of the public tokenizers library."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        letters, vocab = byte_letters(), data["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in data.get("added_tokens", [])}
        self.bytes_of = {i: bytes(letters[c] for c in token) for token, i in vocab.items()}
        self.bytes_of |= {i: text.encode() for text, i in self.special.items()}
        self.start = [vocab[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])]
        self.merges: dict[int, int] = {}
        pairs = []
        for rank, pair in enumerate(data["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            left, right, whole = vocab[a], vocab[b], vocab[a + b]
            self.merges.setdefault(left << 32 | right, rank << 32 | whole)
            pairs.append((left, right, whole))
        self.lookahead = self._lookahead(pairs)
        made = {whole: (rank, left, right) for rank, (left, right, whole) in reversed([*enumerate(pairs)])}
        plain = [t for t in self.bytes_of if t not in self.special.values()]
        self.ids = {self.bytes_of[t]: t for t in plain}
        self.longest = max(map(len, self.ids))
        self.prefixes = {data[:i] for data in self.ids for i in range(1, len(data) + 1)}
        self.last_of = {t: self._spine(t, made, 2) for t in plain}
        self.first_of = {t: self._spine(t, made, 1) for t in plain}
        self.known_pairs: dict[int, bool] = {}
        self.reachable = {t for t in plain if t in made or len(self.bytes_of[t]) == 1}
        self.special_pattern = re.compile("|".join(map(re.escape, self.special))) if self.special else None

    @staticmethod
    def _spine(token: int, made: dict[int, tuple[int, int, int]], side: int) -> list[tuple[int, int]]:
        """The tokens at the left (1) or right (2) end of ``token`` while it is built, and the rank that ends each."""
        spine, until = [], FOREVER
        while True:
            spine.append((token, until))
            if token not in made:
                return spine[::-1]
            until, token = made[token][0], made[token][side]

    def _lookahead(self, pairs: list[tuple[int, int, int]]) -> int:
        lefts: dict[int, set[int]] = defaultdict(set)
        for left, _, whole in pairs:
            lefts[whole].add(left)
        begins: dict[int, set[int]] = {}

        def begin(token: int) -> set[int]:
            """The token and all tokens that stand at its beginning while it is merged."""
            if token not in begins:
                begins[token] = {token}.union(*(begin(x) for x in lefts[token]))
            return begins[token]

        longest: dict[int, int] = defaultdict(int)
        most = 0
        for left, right, _ in reversed(pairs):
            reach = len(self.bytes_of[left]) + longest[left]
            most = max(most, reach)
            for token in begin(right):
                longest[token] = max(longest[token], reach)
        return most

    def window(self) -> int:
        """Bytes of a run that are held at most: there is always a token that ends before the lookahead."""
        return max(WINDOW, self.longest) + self.lookahead

    def fits(self, a: int, b: int) -> bool:
        """Whether ``a`` and ``b`` stay apart when their bytes are merged next to each other.

        While both are built up, the token left of the border and the one right of it change at known ranks; they
        merge if their pair's rank comes before the next change on the left, or with the one on the right (of
        equal ranks the leftmost pair is merged first).
        """
        key = a << 32 | b
        known = self.known_pairs.get(key)
        if known is not None:
            return known
        lefts, rights, i, j, apart = self.last_of[a], self.first_of[b], 0, 0, True
        while True:
            (x, until_x), (y, until_y) = lefts[i], rights[j]
            rank = self.merges.get(x << 32 | y, NONE) >> 32
            if rank < until_x and rank <= until_y and rank < NONE >> 32:
                apart = False
                break
            if until_x == until_y == FOREVER:
                break
            if until_x <= until_y:
                i += 1
            else:
                j += 1
        if len(self.known_pairs) >= REMEMBERED:
            self.known_pairs.clear()
        self.known_pairs[key] = apart
        return apart

    def encode(self, data: bytes) -> list[int]:
        """Token ids of a piece.

        A sequence of tokens is the merge result exactly if each two neighbours fit (Berglund and van der Merwe
        2023), so the longest token that fits the one before it is tried first; a place from which no token leads on
        is left for good.
        """
        whole = self.ids.get(data)
        if whole is not None and whole in self.reachable:
            return [whole]
        ids, fits, prefixes, n = self.ids.get, self.fits, self.prefixes, len(data)
        out: list[int] = []
        starts: list[int] = []
        dead: set[int] = set()
        at, longest = 0, n + 1
        while at < n:
            end = at + 1
            while end < n and data[at : end + 1] in prefixes:
                end += 1
            end = min(end, longest)
            token = None
            while end > at:
                token = ids(data[at:end])
                if token is not None and end not in dead and (not out or fits(out[-1], token)):
                    break
                token = None
                end -= 1
            if token is None:
                dead.add(at)
                longest = at - 1
                at = starts.pop()
                out.pop()
                continue
            out.append(token)
            starts.append(at)
            at, longest = end, n + 1
        return out

    def merge(self, data: bytes) -> list[int]:
        """The same by definition: the pair of lowest rank first, the leftmost of equals."""
        ids = [self.start[b] for b in data]
        while True:
            ranks = [self.merges.get(a << 32 | b, NONE) for a, b in zip(ids, ids[1:])]
            best = min(ranks, default=NONE)
            if best == NONE:
                return ids
            i = ranks.index(best)
            ids[i : i + 2] = [best & 0xFFFFFFFF]


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=4)
def encoder_of(path: str) -> Encoder:
    """One encoder per worker, so that what it remembers serves its next tasks too."""
    return Encoder(vocabulary(path))


class RunEncoder:
    """One piece of any length: emits tokens as soon as no later byte can change them."""

    def __init__(self, vocab: Vocabulary, emit: Callable[[list[int]], None]) -> None:
        self.vocab, self.emit, self.held = vocab, emit, b""

    def feed(self, data: bytes) -> None:
        size = self.vocab.window()
        at = 0
        while len(self.held) + len(data) - at > size:
            taken = size - len(self.held)
            self.held += data[at : at + taken]
            at += taken
            self._settle()
        self.held += data[at:]

    def _settle(self) -> None:
        final, end = len(self.held) - self.vocab.lookahead, 0
        ids = self.vocab.encode(self.held)
        for n, token in enumerate(ids):
            size = len(self.vocab.bytes_of[token])
            if end + size > final:
                break
            end += size
        else:
            n = len(ids)
        self.emit(ids[:n])
        self.held = self.held[end:]

    def finish(self) -> None:
        self.emit(self.vocab.encode(self.held))
        self.held = b""


def encode_piece(vocab: Vocabulary, piece: str, emit: Callable[[list[int]], None]) -> None:
    data = piece.encode()
    if len(data) <= vocab.window():
        return emit(vocab.encode(data))
    run = RunEncoder(vocab, emit)
    run.feed(data)
    run.finish()


class Parts(dict):
    """Part of a text (a word with the white space before it) to its packed ids.

    Two generations of at most ``REMEMBERED`` parts: when the younger one is full it replaces the older one.
    """

    def __init__(self, vocab: Vocabulary, before: str) -> None:
        super().__init__()
        self.vocab, self.before, self.older = vocab, before, {}

    def __missing__(self, part: str) -> bytes:
        packed = self.older.get(part)
        if packed is None:
            packed = self._pack(part)
        if len(part) < 256:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[part] = packed
        return packed

    def _pack(self, part: str) -> bytes:
        if part.isalpha() and len(part) < 256 and self.before != "\n":
            return array("i", self.vocab.encode((self.before + part).encode())).tobytes()
        if len(part) > 1 and part[-1] in ".,!?|:;" and part[-2].isalpha():
            return self[part[:-1]] + array("i", self.vocab.encode(part[-1].encode())).tobytes()
        ids: list[int] = []
        for piece in PIECES.findall(self.before + part):
            encode_piece(self.vocab, piece, ids.extend)
        return array("i", ids).tobytes()


class Encoder:
    """Encodes texts block by block; ``encode`` yields packed 32-bit ids."""

    def __init__(self, vocab: Vocabulary) -> None:
        self.vocab = vocab
        self.first, self.spaced, self.lined = Parts(vocab, ""), Parts(vocab, " "), Parts(vocab, "\n")

    def encode(self, text: str) -> Iterator[bytes]:
        at = 0
        found = self.vocab.special_pattern.finditer(text) if self.vocab.special_pattern else ()
        for m in found:
            yield from self._plain(text, at, m.start())
            yield array("i", [self.vocab.special[m[0]]]).tobytes()
            at = m.end()
        yield from self._plain(text, at, len(text))

    def _plain(self, text: str, at: int, end: int) -> Iterator[bytes]:
        while end - at > BLOCK:
            cut = self._clean_cut(text, at, at + BLOCK)
            if cut is None:
                yield from self._by_pattern(text, at, end)
                return
            yield from self._block(text[at:cut])
            at = cut
        yield from self._block(text[at:end])

    @staticmethod
    def _clean_cut(text: str, at: int, end: int) -> int | None:
        """The last place in the block where a single space stands between two characters that aren't white space."""
        cut = end - 1
        while (cut := text.rfind(" ", at + 1, cut)) > 0:
            if not (text[cut - 1].isspace() or text[cut + 1].isspace()) and not ODD_SPACE.search(text[cut - 1 : cut + 2]):
                return cut
        return None

    def _block(self, block: str) -> Iterator[bytes]:
        if not block:
            return
        if ODD_SPACE.search(block) or block[0] == "\n" or block[-1] in " \n":
            yield from self._by_pattern(block, 0, len(block))
            return
        lines = block.split("\n")
        spaced = self.spaced.__getitem__
        for i, line in enumerate(lines):
            words = line.split(" ")
            if words[0]:  # else the block begins with a space
                yield (self.lined if i else self.first)[words[0]]
            yield b"".join(map(spaced, words[1:]))

    def _by_pattern(self, text: str, at: int, end: int) -> Iterator[bytes]:
        """Pieces one after another, their ids passed on in blocks."""
        ids: list[int] = []
        for m in PIECES.finditer(text[at:end]):
            piece = m[0]
            if len(piece) < 64:
                if len(ids) + len(piece) > BLOCK:
                    yield array("i", ids).tobytes()
                    ids.clear()
                ids.extend(np.frombuffer(self.first[piece], np.int32).tolist() if len(piece) < 32 else self.vocab.encode(piece.encode()))
                continue
            encode_piece(self.vocab, piece, ids.extend)
        yield array("i", ids).tobytes()


class Decoder:
    """Ids to text block by block: bytes of the tokens, then an incremental UTF-8 decoder."""

    def __init__(self, vocab: Vocabulary) -> None:
        self.bytes_of = vocab.bytes_of.__getitem__
        self.utf8 = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: list[int]) -> str:
        return self.utf8.decode(b"".join(map(self.bytes_of, ids)))

    def decode(self, ids: np.ndarray) -> str:
        blocks = [self.feed(ids[i : i + BLOCK].tolist()) for i in range(0, len(ids), BLOCK)]
        return "".join([*blocks, self.finish()])

    def finish(self) -> str:
        rest = self.utf8.decode(b"", True)
        self.utf8.reset()
        return rest


def encode_documents(docs: DataFrame, path: str, column: str = "text", verify: bool = False) -> DataFrame:
    """Every column of ``docs`` and ``tokens``, the ids of the text.

    With ``verify`` also ``round_trip``: whether decoding the ids gives the text again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path)
        decoder = Decoder(encoder.vocab)
        for batch in batches:
            at = batch.schema.get_field_index(column)
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts = [t or "" for t in part.column(at).to_pylist()]
                ids = [np.frombuffer(b"".join(encoder.encode(t)), np.int32) for t in texts]
                ends = pa.array(np.cumsum([0, *map(len, ids)]), pa.int32())
                arrays = [*part.columns, pa.ListArray.from_arrays(ends, pa.array(np.concatenate(ids)))]
                names = [*part.schema.names, "tokens"]
                if verify:
                    arrays.append(pa.array([decoder.decode(i) == t for i, t in zip(ids, texts)]))
                    names.append("round_trip")
                yield pa.RecordBatch.from_arrays(arrays, names)

    plain = docs.drop("tokens", "round_trip") if verify else docs.drop("tokens")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields)
    return plain.mapInArrow(run, f"{fields}, tokens array<int>" + ", round_trip boolean" * verify)


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id`` and the text that the ids in ``tokens`` stand for; null ids give the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(vocabulary(path))
        for batch in batches:
            texts = [decoder.decode(np.array(ids or [], np.int32)) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "tokens").mapInArrow(run, f"doc_id {kind}, text string")


def round_trip_digests(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: both transducers in one pass, digested block by block."""

    def digests(encoder: Encoder, decoder: Decoder, decimal: list[bytes], text: str) -> tuple[int, str, str]:
        ids_digest, text_digest, n = hashlib.sha256(), hashlib.sha256(), 0
        held: list[bytes] = []
        size = 0

        def flush() -> int:
            ids = np.frombuffer(b"".join(held), np.int32).tolist()
            held.clear()
            if ids:
                ids_digest.update((b"," if n else b"") + b",".join(map(decimal.__getitem__, ids)))
                text_digest.update(decoder.feed(ids).encode())
            return len(ids)

        for packed in encoder.encode(text):
            held.append(packed)
            size += len(packed)
            if size > 4 * BLOCK:
                n += flush()
                size = 0
        n += flush()
        text_digest.update(decoder.finish().encode())
        return n, ids_digest.hexdigest(), text_digest.hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        encoder, decoder = encoder_of(path), Decoder(vocab)
        decimal = [b"%d" % i for i in range(max(vocab.bytes_of) + 1)]
        for batch in batches:
            found = [digests(encoder, decoder, decimal, t) for t in batch.column(1).to_pylist()]
            columns = [list(c) for c in zip(*found)] or [[], [], []]
            kinds = (pa.int64(), pa.string(), pa.string())
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    narrow = docs.select("doc_id", text_of().alias("text"))
    return narrow.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


