import random
import sys

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallyhouse.llm import bpe
from tallyhouse.llm.bpe import Decoder, Merges, Transducer, byte_alphabet, encode_digests, encode_documents, load, token_rows

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_padding()
    t.no_truncation()
    return t


def texts():
    r = random.Random(1)
    out = ["", " ", "Hi<|endoftext|>there <|startoftext|> x", "ΑΣ ΣΑ İstanbul it's We'LL 123½ é ẛ̣ a b\x1cc", "a" * 5000, "😂" * 200, "the" * 900, "ab՘c \U000323b5"]
    out += ["".join(r.choice("abcdeinthrsou") for _ in range(r.randint(1, 30))) for _ in range(300)]
    out += ["".join(r.choice("inthear") for _ in range(r.randint(100, 900))) for _ in range(20)]
    out += ["".join(chr(r.choice([r.randint(32, 126), r.randint(160, 0x24F), r.randint(0x370, 0x557), r.randint(0x3041, 0x30FF), 0x1F600 + r.randint(0, 60)])) for _ in range(25)) for _ in range(300)]
    return out


def test_ids_and_text_are_the_librarys(library):
    own = load(PATH)
    for t in texts():
        ids = library.encode(t, add_special_tokens=False).ids
        assert own.encode(t) == ids, t[:80]
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_words_come_back_as_text():
    own = load(PATH)
    for t in ("the quick brown fox", "naïve café 😂😂", "日本 語"):
        assert "".join(own.text(own.encode(t))).split() == "".join(t.split(" ")).split() or "".join(own.text(own.encode(t))).strip() == " ".join(own.words.findall(t))


def test_tokens_leave_before_the_end_and_memory_stays_small():
    own = load(PATH).transducer
    fed = 0

    def symbols():
        nonlocal fed
        for _ in range(200):
            for c in "interestingly":
                fed += 1
                yield c

    out = own.feed(symbols())
    next(out)
    assert fed <= own.lookahead + 2 * bpe.FLUSH + 2
    assert own.lookahead == 32 or own.lookahead > 1


def test_small_merge_lists_against_plain_merging():
    r = random.Random(4)

    def plain(merges, word):
        rank, s = {m: i for i, m in enumerate(merges)}, list(word)
        while True:
            at = min(((rank[p], i) for i, p in enumerate(zip(s, s[1:])) if p in rank), default=None)
            if at is None:
                return s
            pair, out, i = merges[at[0]], [], 0
            while i < len(s):
                if i + 1 < len(s) and (s[i], s[i + 1]) == pair:
                    out.append(s[i] + s[i + 1])
                    i += 2
                else:
                    out.append(s[i])
                    i += 1
            s = out

    for _ in range(60):
        known, merges, made = list("abc"), [], set("abc")
        for _ in range(r.randint(1, 12)):
            pair = r.choice(known), r.choice(known)
            if "".join(pair) not in made:
                merges.append(pair)
                made.add("".join(pair))
                known.append("".join(pair))
        t = Transducer(Merges({k: i for i, k in enumerate(known)}, merges))
        for _ in range(30):
            word = "".join(r.choice("abc") for _ in range(r.randint(0, 200)))
            assert list(t.feed(word)) == (plain(merges, word) if word else [])
    with pytest.raises(ValueError):
        Merges({}, [("ab", "c"), ("a", "b")])
    with pytest.raises(ValueError):
        list(Transducer(Merges({"a": 0}, [])).feed("b"))


def test_decoder_joins_split_characters():
    names = byte_alphabet()
    d = Decoder()
    assert [d.feed(names[b]) for b in "é".encode()] == ["", "é"] and d.feed(names[0xC3]) == "" and d.close() == "�"


def test_documents(spark, library):
    rows = [(1, "Hello there"), (1, "Hello there"), (2, None), (3, ""), (None, "x" * 3000)]
    docs = spark.createDataFrame([(d, t, 5) for d, t in rows], "doc_id long, text string, ids int")
    want = sorted((repr(d), library.encode(t or "", add_special_tokens=False).ids) for d, t in rows)
    assert sorted((repr(r.doc_id), list(r.ids)) for r in encode_documents(docs, PATH).collect()) == want
    assert sorted((repr(r.doc_id), list(r.ids)) for r in token_rows(docs, PATH).collect()) == want
    assert sorted(r.n_tokens for r in encode_digests(docs, PATH).collect()) == sorted(len(i) for _, i in want)
    assert encode_digests(docs.limit(0), PATH).collect() == []


def test_stretches_and_small_caches_change_nothing(library, monkeypatch):
    """Cuts after spaces, words that are forgotten and met again, and one word of many stretches."""
    monkeypatch.setattr(bpe, "KEPT_WORDS", 3)
    own = bpe.WordBpe(PATH)
    given = [*texts()[:400], "é" + "́ a" * 50, "x " * 200 + "y" * 500 + "\n" + " ́b" * 40, "a　b c\td" * 30]
    for size in (1, 7, 64):
        for t in given:
            parts = list(bpe.stretches(t, size))
            assert "".join(parts) == t and all(parts)
            monkeypatch.setattr(bpe, "STRETCH", size)
            ids = [int(i) for part in parts for words in own.stream(part) for w in words for i in w[1].split(" ")]
            assert ids == library.encode(t, add_special_tokens=False).ids, (size, t[:60])
    assert list(bpe.stretches("")) == [] and len(own.known) <= 3


def test_digests_are_those_of_whole_texts(spark, library):
    import hashlib

    given = [*texts(), "Ünïcode words and " * 9000]
    rows = {r.doc_id: r for r in encode_digests(spark.createDataFrame(list(enumerate(given)), "doc_id long, text string"), PATH).collect()}
    own = load(PATH)
    for i, t in enumerate(given):
        ids = library.encode(t, add_special_tokens=False).ids
        want = (" ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False), "".join(own.text(ids)))
        assert (rows[i].n_tokens, rows[i].ids_sha256, rows[i].decoded_sha256, rows[i].text_sha256) == (len(ids), *[hashlib.sha256(w.encode()).hexdigest() for w in want])


def test_packed_words_are_the_same_and_take_less_than_half():
    plain, small = bpe.WordBpe(PATH), bpe.WordBpe(PATH, small=True)
    for text in [*texts(), "a\0b \0 c\0", "x" * 70]:
        assert [w for words in small.stream(text) for w in words] == [w for words in plain.stream(text) for w in words]
    assert list(small.known) == list(plain.known)
    size = sum(sys.getsizeof(w) + sum(map(sys.getsizeof, w)) for w in plain.known.values() if isinstance(w, tuple))
    assert sum(map(sys.getsizeof, small.known.values())) < size / 2
