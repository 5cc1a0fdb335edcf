"""Repeated lines against all pairs."""

import random

import pytest

from gaugeline.llm import linededup


def alike(a, b):
    """Edit distance of at most one word, by the textbook recursion."""
    if abs(len(a) - len(b)) > 1:
        return False
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1] <= 1


def units(line, min_words=5):
    """What an edit changes: words, or characters where there are few words; marked by kind."""
    line = line.strip(" \t\r").lower().replace("\t", " ")
    words = line.split(" ")
    if len(words) < min_words and len(line) >= 10:
        return "characters", list(line)
    return "words", words


def brute(rows, min_words=5):
    """Dropped lines for each (id, text)."""
    from collections import defaultdict

    # the order of equal ids is that of a hash: tests use ids with one text
    lines = []
    for i, text in sorted({(i, t) for i, t in rows if t is not None}, key=lambda r: (r[0] is not None, r[0] or 0)):
        for number, line in enumerate(text.split("\n")):
            found = units(line, min_words)
            if found[1] != [""]:
                lines.append((i, number, *found))

    def same(kind, a, other, b):
        if (kind, a) == (other, b):
            return True
        return kind == other and (kind == "characters" or min(len(a), len(b)) >= min_words) and alike(a, b)

    dropped = defaultdict(list)
    for k, (i, number, *line) in enumerate(lines):
        if any(same(*line, *other) for _, _, *other in lines[:k]):
            dropped[i].append(number)
    return dict(dropped)


def result(frame):
    got = linededup.drop_repeated_lines(frame)
    return {r.doc_id: r.dropped_lines for r in got.collect() if r.dropped_lines}


@pytest.mark.parametrize("seed", range(3))
def test_random_lines(docs, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(12)]
    base = [rng.choices(vocabulary, k=rng.randrange(3, 10)) for _ in range(25)]
    rows = []
    for i in range(30):
        lines = []
        for _ in range(rng.randrange(1, 5)):
            words = list(rng.choice(base))
            for _ in range(rng.randrange(3)):
                at = rng.randrange(len(words))
                words[at : at + rng.randrange(2)] = rng.choice([[], [rng.choice(vocabulary)]])
                words = words or ["w0"]
            lines.append(" ".join(words))
        rows.append((i, "\n".join(lines)))
    assert result(docs(*rows)) == brute(rows)


def test_given_documents(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert result(documents) == brute(rows)


def test_edits_at_the_ends_and_repeated_words(docs):
    lines = [
        "a b c d e f", "b c d e f", "a b c d e", "x a b c d e f", "a b c d e f y", "a a b c d e f",
        "a c b d e f", "a b c d e g", "A  b c d e f", "z z z z z", "z z z z", "z z z z z z",
    ]
    rows = list(enumerate(lines))
    assert result(docs(*rows)) == brute(rows)


def test_short_lines_tabs_and_scripts_without_blanks(docs):
    lines = [
        "All rights reserved.", "all rights RESERVED. ", "Menu", "menu", "a b", "a  b", "A B", "", "  ", "}",
        "}", "name\tage\tcity\tzip\tland", "name\tage\ttown\tzip\tland", "NAME age town zip land",
        "这是一个没有空格的句子示例", "这是一个没有空格的句子示范", "这是一个没有空格句子示例", "这是两个没有空格的句子示范",
        "https://example.org/a/b/c", "https://example.org/a/b/d", "https://example.org/x/y/z", "abcdefghij",
        "a b c d e f g h i j", "abcdefghik", "four words in here", "four words in there", "four word in there!",
        " ".join(f"w{i}" for i in range(40)), " ".join(f"w{i}" for i in range(39)),
        " ".join(f"w{i}" for i in range(38)) + " x y", "日本語のテキスト", "日本語のテキスト",
    ]
    rows = list(enumerate(lines))
    want = brute(rows)
    assert result(docs(*rows)) == want
    assert {1, 3, 6, 10, 12, 13, 15, 16, 17, 19, 23, 25, 28, 31} <= set(want) and not {9, 22, 20, 29} & set(want)


def test_no_repeated_line_is_left(spark):
    """Equal lines, counted by SQL on the lines that are left."""
    import duckdb

    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    left = linededup.drop_repeated_lines(rows).select("doc_id", "text").toPandas()
    connection = duckdb.connect()
    count = """
        SELECT count(*) - count(DISTINCT line) FROM (
            SELECT lower(trim(translate(unnest(string_split(text, chr(10))), chr(9) || chr(13), '  '))) AS line
            FROM {}
        ) WHERE line <> ''
    """
    connection.register("kept", left)
    assert connection.execute(count.format("kept")).fetchone()[0] == 0
    assert connection.execute(count.format("'/root/testdata/sf0.01/documents.parquet'")).fetchone()[0] > 1000


def test_the_text_without_its_lines(docs, clashing):
    shared = "this line is in all of them"
    rows = [(1, f"first\n{shared}\nend"), (2, f"{shared}\nsecond\n\n{shared}"), (3, shared), (4, "first")]
    frame = clashing(docs(*rows), "n_lines")
    got = linededup.drop_repeated_lines(frame)
    assert got.columns == [*frame.columns, "n_lines_", "dropped_lines"]
    assert {r.doc_id: (r.text, r.n_lines_, r.dropped_lines) for r in got.collect()} == {
        1: (rows[0][1], 3, None), 2: ("second\n", 4, [0, 3]), 3: ("", 1, [0]), 4: ("", 1, [0]),
    }


def test_odd_rows(docs):
    line = "one two three four five six"
    rows = [(1, None), (2, ""), (3, "\n\n"), (None, line), (4, line), (4, line), (5, "w " * 60_000 + "end"), (6, "w " * 60_000 + "tail")]
    got = linededup.drop_repeated_lines(docs(*rows)).collect()
    texts = sorted((str(r.doc_id), r.text if r.text is None or len(r.text) < 99 else "long") for r in got)
    assert texts == [
        ("1", None), ("2", ""), ("3", "\n\n"), ("4", ""), ("4", ""), ("5", "long"), ("6", ""), ("None", line),
    ]
    assert linededup.drop_repeated_lines(docs()).count() == 0


def test_equal_ids_with_different_texts(docs):
    line = "one two three four five six"
    got = linededup.drop_repeated_lines(docs((1, f"{line}\na"), (1, f"{line}\nb"))).collect()
    assert sorted(len(r.dropped_lines or []) for r in got) == [0, 1]


def test_no_python_on_the_main_path(documents):
    plan = linededup.drop_repeated_lines(documents)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "MapIn"))
