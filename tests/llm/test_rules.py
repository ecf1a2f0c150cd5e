import random
import re
from collections import Counter

from tallyhouse.llm.rules import POLICIES, ablations, apply_policy, ledger, mask_of, rules


def measures(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    hit = {i + k for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit)


def texts():
    r = random.Random(6)
    out = [None, "", " \n\t", "a b", "a a a", "a a a a", "é\x1cb c", "x\n\nx\n x", "# * $ | <>&%", "\x0ba b c a b c\x0c", "SHOUT " * 60, "a b c " * 5000]
    return out + [" ".join(r.choice("ab cd e\nf g,".split(" ")) for _ in range(r.randint(0, 200))) for _ in range(60)]


def rows(spark):
    return spark.createDataFrame([(i // 2, t, 7, "x") for i, t in enumerate(texts())], "doc_id long, text string, failed int, bits string")


def test_measurements_against_plain_counting(spark):
    got = sorted((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in ledger(rows(spark)).collect())
    assert got == sorted((i // 2, *measures(t)) for i, t in enumerate(texts()))


def test_policies_and_ablations_are_arithmetic_on_the_bits(spark):
    found = ledger(rows(spark)).cache()
    names = [r.name for r in rules()]
    bits = [r.failed for r in found.collect()]
    for version, used in POLICIES.items():
        mask = mask_of(used)
        assert sorted(r.kept for r in apply_policy(found, version).collect()) == sorted(b & mask == 0 for b in bits)
        want = {}
        for n in used:
            bit = 1 << names.index(n)
            want[n] = (sum(b & bit != 0 for b in bits), sum(b & mask == bit for b in bits), sum(b & mask & ~bit == 0 for b in bits))
        assert {r[0]: tuple(r)[1:] for r in ablations(found, version).collect()} == want
    assert "Python" not in found._jdf.queryExecution().toString()
    assert ledger(rows(spark).limit(0)).collect() == []
