"""BPE encoding as a streaming transducer with bounded lookahead, and decoding by an incremental byte-to-text machine.

Encoding one word left to right keeps, for every prefix, the last token of that prefix's encoding. That token is the one whose
border with the token before it no merge would cross (`Merges.stable`), so no merge list is replayed over the whole word. A
token is emitted once every prefix that a later token could still start from has it in its encoding. Later tokens reach back
`Transducer.lookahead` symbols at most, the length of the longest token that a merge makes, so only those prefixes are looked at;
what is kept is their encodings back to where they agree, and for usual merge lists that is a few tokens.

The vocabulary file is a parameter. It has to be a plain BPE without unknown, continuation or byte-fallback tokens.
"""

from __future__ import annotations

import codecs
import hashlib
import json
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from unicodedata import is_normalized, normalize

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.blocks import parts

KEPT_WORDS = 200_000  # encoded words that a task remembers, twice
FLUSH = 64  # symbols between two looks for stable tokens
STRETCH = 1 << 16  # characters of a text worked on at a time
# Letters and digits of this machine's regex module that the tokenizers library's Unicode tables do not have yet.
NEWER = """
0558 058B-058C 088F 0C5C 0CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959
10D40-10D49 10EC5-10EC7 10ED9-10EEE 116D0-116E3 11B0A 11BF0-11BF9 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F
12550-12686 16130-16139 16D70-16D79 16EA0-16EB8 16EBB-16ED3 16FF2-16FF6 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2
18E00-19191 191A0-191D2 1B123-1B128 1B168 1CCF0-1CCF9 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E5F1-1E5FA
1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479
3D000-3FC3F
"""
_NEWER_SET = "[" + "".join("-".join(f"\\U{int(x, 16):08X}" for x in r.split("-")) for r in NEWER.split()) + "]"
_OUT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, text_sha256 string"


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


ALPHABET = byte_alphabet()
_UTF8 = codecs.getincrementaldecoder("utf-8")
_BYTE_OF = str.maketrans({c: chr(b) for b, c in enumerate(ALPHABET)})


class Merges:
    """A merge list as tokens with their ranks."""

    def __init__(self, vocab: dict[str, int], pairs: Iterable[tuple[str, str]]):
        self.vocab = vocab
        self.rank = {pair: i for i, pair in enumerate(pairs)}
        self.parts: dict[str, tuple[str, str]] = {}
        for a, b in self.rank:
            if self.parts.setdefault(a + b, (a, b)) != (a, b):
                raise ValueError(f"two merges make the token {a + b!r}")
        for (a, b), r in self.rank.items():
            if any(t in self.parts and self.rank[self.parts[t]] >= r for t in (a, b)):
                raise ValueError(f"the merge {a!r} {b!r} comes before its parts")
        self._spines = lru_cache(1 << 16)(self._spine)
        self.stable = lru_cache(1 << 16)(self._stable)
        self.made = {t for t in vocab if t not in self.parts}  # tokens that their own text is encoded as
        for token, (a, b) in self.parts.items():  # in the order of merges, so after its parts
            if a in self.made and b in self.made and self._stable(a, b, self.rank[a, b]):
                self.made.add(token)

    def _spine(self, token: str, side: int) -> list[tuple[str, float]]:
        """The tokens at one edge of a token while it is made, each with the rank of the merge that takes it in."""
        out, until = [(token, float("inf"))], float("inf")
        while token in self.parts:
            until = self.rank[self.parts[token]]
            token = self.parts[token][side]
            out.append((token, until))
        return out

    def _stable(self, left: str, right: str, until: float = float("inf")) -> bool:
        """No merge before `until` crosses the border of the two tokens while each is made. Of equal ranks the leftmost comes first."""
        for a, a_until in self._spines(left, 1):
            for b, b_until in self._spines(right, 0):
                r = self.rank.get((a, b))
                if r is not None and r < a_until and r <= b_until and r < until:
                    return False
        return True


class Transducer:
    """Encodes words of symbols; `end` is what the last symbol of a word gets appended.

    The tokens that end at a symbol come from one Aho-Corasick automaton over all tokens that are encoded as themselves, longest
    first; the first one whose border to the token before it is stable is the last token of the prefix that ends there.
    """

    MARK = "\0"  # stands for `end` in the automaton

    def __init__(self, merges: Merges, end: str = ""):
        self.merges, self.end = merges, end
        self.automaton = ahocorasick.Automaton()
        self.lookahead = 1
        for t in merges.vocab:
            last = end and t.endswith(end) and len(t) > len(end)
            size = len(t) - len(end) if last else len(t)
            if t in merges.made and t:
                self.automaton.add_word(t[:size] + self.MARK if last else t, (t, size))
            if t in merges.parts or not merges.parts:
                self.lookahead = max(self.lookahead, size)
        self.automaton.make_automaton()

    def _chunks(self, word: Iterable[str]) -> Iterator[tuple[str, bool]]:
        """Up to `FLUSH` symbols at a time, and whether the word ends with them."""
        if isinstance(word, str) and len(word) <= FLUSH:
            if word:
                yield word, True
            return
        held: list[str] = []
        for c in word:
            if len(held) == FLUSH:
                yield "".join(held), False
                held.clear()
            held.append(c)
        if held:
            yield "".join(held), True

    def _settle(self, matches: Iterable[tuple[int, tuple[str, int]]], last: list[tuple[str, int]], read: int, gone: int, marked: bool) -> None:
        """Adds the last token of each prefix that ends in the text just searched. `read` symbols are read, `gone` of them emitted."""
        stable, shift, skipped, settled = self.merges.stable, 1 - gone, read - 1 if marked else -1, -1
        for at, found in matches:
            if at == settled or at == skipped:  # what ends at the last symbol of a word has to hold the mark
                continue
            n, size = at + shift if at < read else at + shift - 1, found[1]
            if size == n or size < n and stable(last[n - size - 1][0], found[0]):
                if len(last) != n - 1:
                    break
                last.append(found)
                settled = at
        if len(last) < read - gone:
            raise ValueError(f"the vocabulary has no token for symbol {gone + len(last)} of a word")

    @staticmethod
    def _back(last: list[tuple[str, int]], n: int) -> list[str]:
        """The tokens of the first n symbols, by steps back from the last of them."""
        out = []
        while n > 0:
            token, size = last[n - 1]
            out.append(token)
            n -= size
        out.reverse()
        return out

    def encode(self, word: str) -> list[str]:
        """Tokens of a word; a short one in one step."""
        if len(word) > FLUSH or not word or not len(self.automaton):
            return list(self.feed(word))
        last: list[tuple[str, int]] = []
        self._settle(self.automaton.iter(word + self.MARK if self.end else word), last, len(word), 0, bool(self.end))
        return self._back(last, len(word))

    def feed(self, word: Iterable[str]) -> Iterator[str]:
        """Tokens of one word, each as soon as it is stable."""
        search = self.automaton.iter("") if len(self.automaton) else None
        last: list[tuple[str, int]] = []  # for each prefix of what is kept: its last token, and how many symbols that has
        read = gone = 0  # symbols read, and those of them in tokens that were emitted
        for chunk, is_end in self._chunks(word):
            read += len(chunk)
            marked = is_end and bool(self.end)
            if search is not None:
                search.set(chunk + self.MARK if marked else chunk)
            self._settle(search or (), last, read, gone, marked)
            if not is_end and len(last) > self.lookahead:
                out = self._flush(last)
                gone = read - len(last)
                yield from out
        yield from self._back(last, len(last))

    def _flush(self, last: list[tuple[str, int]]) -> list[str]:
        """Tokens that the encodings of all prefixes in reach share, taken out of what is kept."""
        heads = set(range(max(1, len(last) - self.lookahead + 1), len(last) + 1))
        while len(heads) > 1:  # step back from the longest until all meet
            top = max(heads)
            heads.discard(top)
            heads.add(top - last[top - 1][1])
        cut = heads.pop()
        out = self._back(last, cut)
        del last[:cut]
        return out


class Decoder:
    """Tokens to text one by one; a byte-level token may end within a character, whose bytes are then kept for the next."""

    def __init__(self, end: str = ""):
        self.end = end
        self.machine = _UTF8("replace")
        self.known: dict[str, tuple[bytes, str]] = {}  # bytes of each token met, and the space after a word's last one

    def feed(self, token: str) -> str:
        found = self.known.get(token)
        if found is None:
            ends = bool(self.end) and token.endswith(self.end)
            body = token[: -len(self.end)] if ends else token
            found = self.known[token] = body.translate(_BYTE_OF).encode("latin-1"), " " if ends else ""
        return self.machine.decode(found[0]) + found[1]

    def close(self) -> str:
        return self.machine.decode(b"", True)


#: A word encoded, and decoded from its ids: number of tokens; decimal ids, joined by a space; the text as the library decodes
#: them; the readable text of the byte-to-text machine.
Word = tuple[int, str, str, str]


def packed(word: Word) -> str:
    """A word as one string, which takes less than half of its tuple's memory; neither ids nor tokens hold the mark."""
    return Transducer.MARK.join(word[1:])


def unpacked(word: str) -> Word:
    ids, decoded, text = word.split(Transducer.MARK, 2)
    return ids.count(" ") + 1, ids, decoded, text


class Known(dict):
    """Words met before, up to twice `KEPT_WORDS` of them; the longest unused half goes when it is full."""

    def __init__(self, make: Callable[[str], Word | str]):
        super().__init__()
        self.make, self.before = make, {}

    def __missing__(self, word: str) -> Word | str:
        found = self.before.get(word) or self.make(word)
        if len(word) <= 64:
            if len(self) >= KEPT_WORDS:
                self.before = dict(self)
                self.clear()
            self[word] = found
        return found


def stretches(text: str, size: int = STRETCH) -> Iterator[str]:
    """The text cut after spaces or line feeds, about `size` characters each; no word, normal form or added token crosses a cut."""
    at = 0
    while at < len(text):
        end = at + size
        if end < len(text):
            cut = max(text.rfind(" ", at, end), text.rfind("\n", at, end))
            if cut < 0:
                cut = min((i for i in (text.find(" ", end), text.find("\n", end)) if i >= 0), default=len(text))
            end = cut + 1
        yield text[at:end]
        at = end


class Digests:
    """Hashes over the words of a text as they come."""

    def __init__(self):
        self.tokens = 0
        self.hashes = [hashlib.sha256() for _ in range(3)]
        self.started = False

    def add(self, words: list[Word]) -> None:
        tokens, ids, decoded, text = zip(*words)
        self.tokens += sum(tokens)
        gap = " " if self.started else ""
        for h, joined in zip(self.hashes, (gap + " ".join(ids), gap + " ".join(decoded), "".join(text))):
            h.update(joined.encode())
        self.started = True

    def row(self) -> tuple:
        return self.tokens, *(h.hexdigest() for h in self.hashes)


class WordBpe:
    """A vocabulary file of the tokenizers library whose words are split by a pattern and end in a suffix.

    With `small` it remembers words packed: it takes a sixth more time, and workers that other stages go on with hold less.
    """

    def __init__(self, path: str, small: bool = False):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("unk_token") or model.get("continuing_subword_prefix") or model.get("byte_fallback") or model.get("dropout") or model.get("ignore_merges"):
            raise ValueError("only plain BPE vocabularies are read")
        steps = [s["type"] for s in spec["normalizer"]["normalizers"]]
        split, level = spec["pre_tokenizer"]["pretokenizers"]
        if steps != ["NFC", "Replace", "Lowercase"] or split["behavior"] != "Removed" or not split["invert"] or level["type"] != "ByteLevel" or level["use_regex"] or level["add_prefix_space"] or spec.get("decoder"):
            raise ValueError("the vocabulary's text steps are not those read here")
        self.end = model["end_of_word_suffix"] or ""
        self.vocab = model["vocab"]
        self.transducer = Transducer(Merges(self.vocab, [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]), self.end)
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in (self.vocab | self.added).items()}
        pattern = split["pattern"]["Regex"]
        self.words = regex.compile(pattern)
        for kind in (r"\p{L}", r"\p{N}"):
            pattern = pattern.replace(kind, f"[{kind}--{_NEWER_SET}]")
        self.words_old = regex.compile(pattern, regex.V1)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        if any(c in a for a in self.added for c in " \n"):
            raise ValueError("an added token holds a space")
        self.machine = Decoder(self.end)
        self.small = small
        self.known = Known((lambda word: packed(self.word(word))) if small else self.word)

    def normal(self, text: str) -> str:
        """NFC and lower case by character, so that no sigma is final; white space goes when words are found."""
        if text.isascii():
            return text.lower()
        text = text if is_normalized("NFC", text) else normalize("NFC", text)
        return text.lower() if "Σ" not in text else "".join(c.lower() for c in text)

    def pieces(self, text: str) -> Iterator[tuple[bool, str]]:
        """(is an added token, text) in order."""
        if self.marks is None or not any(a in text for a in self.added):
            yield False, text
        else:
            for i, part in enumerate(self.marks.split(text)):
                if part:
                    yield bool(i % 2), part

    def word(self, word: str) -> Word:
        """Encodes a word, and decodes it again from its ids. A word is whole characters, so the decoder's state is that at the
        start after each word, and what it gives can be remembered with the word."""
        ids = [self.vocab[t] for t in self.transducer.encode("".join([ALPHABET[b] for b in word.encode()]))]
        return len(ids), " ".join(map(str, ids)), self.decode(ids), "".join(map(self.machine.feed, map(self.names.get, ids)))

    def stream(self, text: str) -> Iterator[list[Word]]:
        """The words of a text, some at a time: memory follows the longest stretch without a space, not the text."""
        for part in stretches(text):
            out = []
            for added, piece in self.pieces(part):
                if added:
                    out.append((1, str(self.added[piece]), piece, piece))
                    continue
                piece = self.normal(piece)
                found = (self.words if piece.isascii() or max(piece) < "\u0558" else self.words_old).findall(piece)
                words = map(self.known.__getitem__, found)
                out.extend(map(unpacked, words) if self.small else words)
            if out:
                yield out

    def encode(self, text: str) -> list[int]:
        return [int(i) for words in self.stream(text) for w in words for i in w[1].split(" ")]

    def decode(self, ids: Iterable[int]) -> str:
        """As the library does for a vocabulary without a decoder: token strings joined by a space."""
        return " ".join(self.names[i] for i in ids if i in self.names)

    def text(self, ids: Iterable[int]) -> Iterator[str]:
        """Readable text, piece by piece: bytes to characters, a space after each word."""
        machine, names, added = Decoder(self.end), self.names, self.added
        for i in ids:
            name = names[i]
            yield machine.close() + name if name in added else machine.feed(name)
        yield machine.close()


@lru_cache(4)
def load(path: str, small: bool = False) -> WordBpe:
    return WordBpe(path, small)


def _mapped(docs: DataFrame, path: str, schema: pa.Schema, out: str, row: Callable[[WordBpe, str], tuple], small: bool = False) -> DataFrame:
    def run(batches):
        bpe = load(path, small)
        for batch in batches:
            for part in parts(batch):
                made = zip(*[row(bpe, t or "") for t in part["text"].to_pylist()])
                yield pa.RecordBatch.from_arrays([part["doc_id"], *(pa.array(list(c), f.type) for c, f in zip(made, list(schema)[1:]))], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, out)


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, token ids, and the decoded text of every document; a null text is empty and has no tokens.

    Row by row without an exchange, so hot keys, repeated rows and clashing column names have no effect; columns but doc_id and
    text are not read. `path` is the vocabulary file, which every worker reads from its own installation.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])

    def row(bpe: WordBpe, text: str) -> tuple:
        ids = bpe.encode(text)
        return ids, bpe.decode(ids)

    return _mapped(docs, path, schema, "doc_id long, ids array<int>, decoded string", row)


_DIGESTS = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()), ("text_sha256", pa.string())]


def token_rows(docs: DataFrame, path: str) -> DataFrame:
    """The columns of `encode_digests`, and the ids themselves (see `encode_documents`). Words are remembered packed."""

    def row(bpe: WordBpe, text: str) -> tuple:
        digests, ids = Digests(), []
        for words in bpe.stream(text):
            digests.add(words)
            ids.append(np.array(" ".join([w[1] for w in words]).split(" "), np.int32))
        return *digests.row(), np.concatenate(ids) if ids else np.zeros(0, np.int32)

    return _mapped(docs, path, pa.schema([*_DIGESTS, ("ids", pa.list_(pa.int32()))]), f"{_OUT}, ids array<int>", row, small=True)


def encode_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, number of tokens, and hashes of the ids, of the text as the library decodes them, and of the readable text that the
    byte-to-text machine makes of them, a space after each word (see `encode_documents`)."""

    def row(bpe: WordBpe, text: str) -> tuple:
        digests = Digests()
        for words in bpe.stream(text):
            digests.add(words)
        return digests.row()

    return _mapped(docs, path, pa.schema(_DIGESTS), _OUT, row)
