import itertools
import math
import random

from planar.llm.filters import LETTERS, audit_orders, filter_audit, mask_cells, text_mask
from tests.llm.helpers import clashing, docs_df

COLS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def mask_of(text):
    import re

    words = re.findall("[^\x20\x09-\x0d]+", text)
    caps = sum("A" <= c <= "Z" for c in text)
    fails = (len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * caps > 10 * len(text), any(c in "#$%&*|" for c in text))
    return sum(f << i for i, f in enumerate(fails))


def brute(rows, labels):
    """rows: (id, text, part)."""
    docs = []
    for i, t, part in rows:
        t = t or ""
        copy = i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in rows)
        flags = [any(j is not None and j == i and lab[k] == 1 for j, *lab in labels) for k in (0, 1)]
        docs.append((part or "", mask_of(t) + 16 * copy, *flags))
    out = []
    for part in sorted({d[0] for d in docs}):
        mine = [d for d in docs if d[0] == part]
        shapley = dict.fromkeys(LETTERS, 0)
        rows_ = []
        for order in itertools.permutations(LETTERS):
            applied = 0
            for step, letter in enumerate(order, 1):
                bit = 1 << LETTERS.index(letter)
                gone = [d for d in mine if d[1] & bit and not d[1] & applied]
                red = sum(1 for d in mine if d[1] & bit and d[1] & applied)
                applied |= bit
                kept = sum(1 for d in mine if not d[1] & applied)
                shapley[letter] += len(gone)
                alone = sum(1 for d in mine if d[1] == bit)
                rows_.append((part, "".join(order), step, kept, len(gone), red, alone, sum(d[2] for d in gone), sum(d[3] for d in gone), letter))
        out += [(*r[:-1], shapley[r[-1]]) for r in rows_]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r[c] for c in COLS) for r in df.collect())


def frame(spark, rows):
    return docs_df(spark, [t for _, t, _ in rows], ids=[i for i, _, _ in rows], lang=[p for _, _, p in rows])


def test_against_brute_force(spark):
    rng = random.Random(5)

    def text():
        n = rng.choice([0, 3, 99, 100, 130])
        words = [rng.choice([f"w{k}", "the", "Été", "CAPS"][: rng.randrange(1, 5)]) for k in range(n)]
        return rng.choice([" ", "\x0b", "\n"]).join(words) + rng.choice(["", "", "#", "|", " a"])

    rows = [(i, text(), rng.choice(["en", "de", None, ""])) for i in range(80)]
    rows += [(200 + i, rows[i % 5][1], "en") for i in range(30)]  # copies
    rows += [(300, None, "fr"), (301, None, None), (302, "", "fr"), (None, rows[0][1], "en"), (None, None, None), rows[3], rows[3], (3, rows[4][1], "de")]
    rows += [(400, "Word%d " * 3, "long"), (401, " ".join(f"w{k}" for k in range(60_000)), "long")]
    rows += [(1, rows[1][1], "xx")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 250, 2)] + [(None, 1, 1), (4, 1, 0), (4, 0, 1), (999, 1, 1)]
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    df = clashing(frame(spark, rows)).withColumnRenamed("mask", "own")
    assert rows_of(filter_audit(df, lab)) == brute(rows, labels)


def test_masks_of_long_texts(monkeypatch):
    from planar.llm import filters

    text = (" ".join(f"w{k % 9000}" for k in range(300_000)) + " É").encode()
    whole = text_mask(text)
    monkeypatch.setattr(filters, "LONG_TEXT", 1000)
    assert text_mask(text) == whole == mask_of(text.decode())


def test_empty_tables(spark):
    lab = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit(docs_df(spark, []), lab).collect() == []
    one = filter_audit(docs_df(spark, ["x"]), lab).collect()
    assert len(one) == 600 and {r["part"] for r in one} == {""} and {r["good_lost"] for r in one} == {0}


def test_any_number_of_filters(spark):
    cells = spark.createDataFrame([("p", m, 10**12 + m, m, 0) for m in range(8)], "part string, mask int, n long, good long, toxic long")
    got = audit_orders(cells, "XYZ").collect()
    assert len(got) == 18
    by = {(r["filter_order"], r["step"]): r for r in got}
    assert by["XYZ", 1]["removed"] == 4 * 10**12 + 16 and by["ZXY", 3]["kept"] == 10**12
    total = sum({r["filter_order"][r["step"] - 1]: r["shapley"] for r in got}.values())
    assert total == math.factorial(3) * sum(10**12 + m for m in range(1, 8))


def test_cells_count_each_row_once(spark):
    rows = [(i % 7, "same text", "en") for i in range(50)]
    cells = mask_cells(frame(spark, rows), spark.createDataFrame([(0, 1, 1)], "doc_id long, quality int, toxic int")).collect()
    assert sum(r["n"] for r in cells) == 50
    assert {(r["mask"], r["n"], r["good"]) for r in cells} == {(1, 8, 8), (17, 42, 0)}
