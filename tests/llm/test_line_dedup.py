import random

import pytest

from docspark.llm import line_dedup as ld


def brute(rows, size):
    """(key, lines, removed, runs, kept) per row; the first copy of each run of ``size`` lines stays."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, i))
    seen, out = set(), []
    for i in order:
        k, t = rows[i]
        lines = [] if t is None else t.split("\n")
        gone = [False] * len(lines)
        for p in range(len(lines) - size + 1):
            run = tuple(lines[p: p + size])
            if run in seen:
                gone[p: p + size] = [True] * size
            seen.add(run)
        runs = sum(g and not (p and gone[p - 1]) for p, g in enumerate(gone))
        kept = None if t is None else "\n".join(x for x, g in zip(lines, gone) if not g)
        out.append((k, len(lines), sum(gone), runs, kept))
    return sorted(out, key=str)


def corpus():
    rnd = random.Random(5)
    vocab = [f"line {i}" for i in range(40)] + ["", "common"] * 4
    rows = [(None, None), (1, ""), (2, "a\nb\nc\nd"), (2, "a\nb\nc\nd"), (2, "a\nb\nc\nd"), (3, "one"), (3, "one"), (4, "\n\n\n\n\n\n")]
    block = rnd.choices(vocab, k=9)
    for i in range(80):
        lines = rnd.choices(vocab, k=rnd.randint(1, 30))
        if rnd.random() < 0.5:
            at = rnd.randint(0, len(lines))
            lines[at:at] = block[rnd.randint(0, 3): rnd.randint(4, 9)]
        rows.append((1000 - i, "\n".join(lines)))
    rows.append((5000, "\n".join(["x", "y"] * 3000)))
    return rows


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5, 7])
def test_equals_brute_force(spark, size):
    rows = corpus()
    df = spark.createDataFrame([(*r, "q") for r in rows], "doc_id long, text string, n_runs string").repartition(3)
    got = ld.drop_repeated_lines(df, min_lines=size).collect()
    assert sorted(((r.doc_id, r.n_lines, r.n_removed, r.n_runs, r.kept_text) for r in got), key=str) == brute(rows, size)
    assert {r.n_runs_in for r in got} == {"q"}


def test_plan_is_native(spark):
    df = spark.createDataFrame(corpus(), "doc_id long, text string")
    plan = ld.drop_repeated_lines(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan and "Cartesian" not in plan


def test_empty_table(spark):
    assert ld.drop_repeated_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def brute_words(rows, size, words):
    """(key, removed, runs, kept) per row; besides, later copies of fewer lines with ``words`` words go."""
    seen, out = set(), []
    for k, t in sorted(rows):
        lines = t.split("\n")
        gone = [False] * len(lines)
        for n in range(1, size + 1):
            for p in range(len(lines) - n + 1):
                run = tuple(lines[p: p + n])
                if n < size and len(" ".join(run).split()) < words:
                    continue
                if run in seen:
                    gone[p: p + n] = [True] * n
                seen.add(run)
        runs = sum(g and not (p and gone[p - 1]) for p, g in enumerate(gone))
        out.append((k, sum(gone), runs, "\n".join(x for x, g in zip(lines, gone) if not g)))
    return out


@pytest.mark.parametrize("size,words", [(3, 6), (5, 9)])
def test_short_runs_of_many_words_go(spark, size, words):
    rnd = random.Random(9)
    vocab = [" ".join(rnd.choices("abcdefgh", k=rnd.randint(0, 8))) for _ in range(30)]
    rows = [(i, "\n".join(rnd.choices(vocab, k=rnd.randint(1, 12)))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = ld.drop_repeated_lines(df, min_lines=size, min_words=words).collect()
    assert sorted((r.doc_id, r.n_removed, r.n_runs, r.kept_text) for r in got) == brute_words(rows, size, words)


def test_one_long_line_repeated_whole(spark):
    passage, short = " ".join(f"w{i}" for i in range(50)), " ".join(f"w{i}" for i in range(49))
    rows = [(1, passage), (2, passage), (2, passage), (3, "own\n" + passage), (4, short), (5, short)]
    got = ld.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_removed, r.kept_text) for r in got) == [
        (1, 0, passage), (2, 1, ""), (2, 1, ""), (3, 1, "own"), (4, 0, short), (5, 0, short)]
