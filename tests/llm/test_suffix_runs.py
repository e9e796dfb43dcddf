"""Copied bytes found by runs of windows, against plain search; what is written grows with the
runs, not with the bytes."""

import random

from lexmill.llm import suffixes

LENGTH = suffixes.LENGTH


def plain(rows):
    first, out = {}, []
    bodies = [(d if d is not None else 1 << 63, (t or "").encode()) for d, t in rows]
    for doc, data in bodies:
        for i in range(len(data) - LENGTH + 1):
            window = data[i : i + LENGTH]
            first[window] = min(first.get(window, doc), doc)
    for doc, data in bodies:
        gone = set()
        for i in range(len(data) - LENGTH + 1):
            if first[data[i : i + LENGTH]] < doc:
                gone.update(range(i, i + LENGTH))
        out.append(bytes(b for i, b in enumerate(data) if i not in gone))
    return out


def test_against_plain_search(spark):
    dice = random.Random(5)
    parts = ["".join(dice.choices(letters, k=n)) for letters in ("abcdefgh ", "ab", "éßa") for n in (30, 49, 50, 51, 75, 140)]
    parts += ["-" * 300, "ab" * 90, "\x00" * 120, "xyz" * 30 + "\n"]
    rows = []
    for n in range(150):
        body = "".join(dice.choice(parts)[dice.choice([0, 0, 1, 7]) :] for _ in range(dice.randrange(5)))
        at = dice.randrange(len(body) + 1)
        rows.append((n // 2 if n < 20 else n, body[:at] + dice.choice(["", "", "Q", "zz"]) + body[at + dice.randrange(3) :]))
    rows += [(None, parts[5] + parts[0]), (None, None), (7, None), (400, parts[5]), (-3, parts[17][3:] + parts[11])]
    docs = spark.createDataFrame([(i, d, t) for i, (d, t) in enumerate(rows)], "i int, doc_id long, text string").repartition(5)
    found = {r.i: bytes(r.kept) for r in suffixes.dedup(docs).collect()}
    assert [found[i] for i in range(len(rows))] == plain(rows)


def test_rows_follow_runs_not_bytes(spark, monkeypatch):
    rows, write = [], suffixes.written
    monkeypatch.setattr(suffixes, "written", lambda df, name="table": rows.append((made := write(df, name)).count()) or made)
    body = "".join(random.Random(1).choices("abcdefghijklmnopqrstuvwxyz ", k=30_000))
    docs = spark.createDataFrame([(n, body[:15_000] + str(n) * 40 + body[15_000:]) for n in range(4)], "doc_id long, text string")
    found = {r.doc_id: r for r in suffixes.dedup(docs).collect()}
    assert len(found[0].kept) == 30_040 and [bytes(found[n].kept).decode() for n in (1, 2, 3)] == [str(n) * 40 for n in (1, 2, 3)]
    assert sum(rows) < 4 * 30_000 / 5
