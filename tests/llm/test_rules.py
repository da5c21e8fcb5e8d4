"""Quality rules: counts by the definition, host verdicts, no Python in the plan."""

import re

from tagweave.llm.rules import host_rates, quality_rules


def slow(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)), len(covered),
    )


TEXTS = [
    None, "", " \n\t", "a", "a b", "a a a a", "a b c a b c x a b", "é#*$ <b> x 😀",
    "l\nl\n l\n\n\nl", "w " * 60, " ".join(f"w{i}" for i in range(60)), "\x1c\x85 x\x0by",
    " ".join(f"{i % 7} {i % 11}" for i in range(300)),
]


def test_counts(spark):
    rows = [(i, t, None if i % 3 else "h", i) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame([*rows, rows[5]], "doc_id bigint, text string, source string, n_words int")
    out = quality_rules(docs).collect()
    assert len(out) == len(TEXTS) + 1
    for r in out:
        want = slow(TEXTS[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, r
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.kept and r.base_failed)


def test_host_verdicts(spark):
    good = " ".join(f"w{i}" for i in range(80))
    symbols = good + " #" * 30
    docs = [(i, good, "fine") for i in range(100)]
    docs += [(100 + i, symbols if i % 5 else good, "bad") for i in range(100)]
    docs += [(200 + i, symbols if i < 2 else good, "fine") for i in range(20)]
    docs += [(300 + i, symbols if i < 35 else good, "suspect") for i in range(100)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, source string")
    kept = {r.doc_id for r in quality_rules(df).filter("kept").collect()}
    assert kept & set(range(100, 200)) == set()  # the whole host
    assert set(range(100)) | set(range(200, 220)) <= kept  # breaking a rule is fine on a good host
    assert kept & set(range(300, 400)) == set(range(335, 400))


def test_rates_are_shrunk_towards_all_hosts(spark):
    rows = [("big", 100, 0, 2, 0, 0, 10)] * 50 + [("small", 10, 0, 0, 0, 0, 10)]
    df = spark.createDataFrame(
        rows, "host string, n_words bigint, n_repeat_words bigint, n_symbols bigint, n_dup_lines bigint, x int, n_lines int"
    )
    rates = {r.host: r for r in host_rates(df).filter("rule = 'short'").collect()}
    assert rates["small"].fails == rates["small"].n == 1
    assert 0 < rates["big"].rate < 0.5 < rates["small"].rate < 1


def test_empty_table_and_plan(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, source string")
    out = quality_rules(docs)
    assert out.count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
