import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import quality_rules as Q


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = list(zip(words, words[1:], words[2:]))
    count = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if count[g] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(covered))


TEXTS = [None, "", " \n\t", "one", "a b c a b c", "a b c d a b c x a b c", "x x x x x", "l1\nl1\nl1\n\nl2\nl1",
         "SHOUT!! " * 60, "w " * 49, "p q r s t u v w x y " * 6, "é#*$%&|<>ü\x0b\x0cz", "word joined x",
         " ".join(f"w{i}" for i in range(60)), "long " * 20_000, "a b c\n" * 3]


def test_measurements_equal_brute_force(frame):
    docs = frame([(i, t, 1, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, n_words int, t string")
    got = {r.doc_id: r for r in Q.ledger(docs).collect()}
    assert len(got) == len(TEXTS)
    for i, t in enumerate(TEXTS):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(t), repr(t)[:40]


def test_bits_policies_and_ablations(frame):
    docs = frame([(i, t) for i, t in enumerate(TEXTS)])
    led = Q.ledger(docs)
    rows = led.withColumn("kept", Q.passes("v2")).collect()
    for r in rows:
        short = r.n_words < 50
        assert bool(r.fail_bits & 1) == short
        assert r.kept == (r.fail_bits == 0)
    ab = {r.rule: r for r in Q.ablations(led, "v2").collect()}
    assert set(ab) == set(Q.POLICIES["v2"])
    for rule, (bit, _) in Q.RULES.items():
        assert ab[rule].n_failed == sum(bool(r.fail_bits >> bit & 1) for r in rows)
        assert ab[rule].n_only_this == sum(r.fail_bits == 1 << bit for r in rows)
        assert ab[rule].n_kept_without == sum(r.fail_bits & ~(1 << bit) == 0 for r in rows)


def test_repeated_rows_and_empty_table(frame):
    docs = frame([(1, "a b c a b c")] * 3)
    assert Q.ledger(docs).count() == 3
    assert Q.ledger(docs.limit(0)).count() == 0


def test_native_plan(frame):
    plan = Q.ledger(frame([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan) and "Exchange" not in plan


@pytest.mark.parametrize("policy", list(Q.POLICIES))
def test_masks_hold_the_named_rules(policy):
    assert Q.mask(policy) == sum(1 << Q.RULES[r][0] for r in set(Q.POLICIES[policy]))
    assert F.lit(Q.mask(policy)) is not None
