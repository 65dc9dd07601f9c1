import re
from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from kglake.llm import audit


def masks(rows):
    """Brute force, `[(part, doc_id, failed letters)]` of `(doc_id, text, source)` rows."""
    out = []
    for doc_id, text, source in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        failed = ""
        if len(words) < 200:
            failed += "A"
        if 100 * len(set(words)) < 50 * len(words):
            failed += "B"
        if 100 * len(re.findall("[A-Z]", text)) > 2 * len(text):
            failed += "C"
        if re.search(r"[#$%&*|]", text):
            failed += "D"
        if doc_id is not None and any(i is not None and i < doc_id and (t or "") == text for i, t, _ in rows):
            failed += "E"
        out.append((source or "", doc_id, failed))
    return out


def expected(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    failed = masks(rows)
    out, shapley = [], Counter()
    for part in {f[0] for f in failed}:
        own = [f for f in failed if f[0] == part]
        for order in permutations("ABCDE"):
            left = own
            for step, letter in enumerate(order, 1):
                gone = [f for f in left if letter in f[2]]
                before = [f for f in own if letter in f[2] and f not in left]
                left = [f for f in left if letter not in f[2]]
                shapley[part, letter] += len(gone)
                out.append([part, "".join(order), step, len(left), len(gone), len(before),
                            sum(f[2] == letter for f in own), sum(f[1] in good for f in gone), sum(f[1] in toxic for f in gone)])
    return sorted((*r, shapley[r[0], r[1][r[2] - 1]]) for r in out)


ROWS = [
    (1, "Ab cd " * 150, "s"), (2, "Ab cd " * 150, "s"), (3, "Ab cd " * 150, None), (4, " ".join(map(str, range(300))), "s"),
    (5, " ".join(map(str, range(300))) + " #x", ""), (6, None, "t"), (7, "", "t"), (8, "a\x1fb  c d | E", "t"),
    (9, " ".join(f"W{k}" for k in range(250)), None), (10, "one two", "s"), (10, "one two", "s"), (11, "one two", "t"),
    (None, "one two", "s"), (None, "one two", None), (12, "É" * 60 + " Ä" * 210, "s"),
]
LABELS = [(1, 1, 0), (2, 0, 1), (4, 1, 0), (4, 0, 0), (9, 1, 1), (10, None, 1), (99, 1, 1), (None, 1, 1)]


def frames(spark, rows=ROWS, labels=LABELS):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns(
        {name: F.lit("mine") for name in ("row", "part", "mask", "shard", "name", "n_words", "c", "d", "first", "quality", "step")})
    return docs.repartition(3), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_masks_equal_brute_force(spark):
    docs, _ = frames(spark)
    got = sorted(((r.source or "", r.doc_id, "".join(f for k, f in enumerate("ABCDE") if r.mask >> k & 1))
                  for r in audit.failures(docs).collect()), key=repr)
    assert got == sorted(masks(ROWS), key=repr)


def test_audit_equals_every_order(spark):
    docs, labels = frames(spark)
    got = sorted(map(tuple, audit.audit(audit.failures(docs), labels).collect()))
    assert got == expected(ROWS, LABELS)
    assert len(got) == 600 * 3


def test_prose_of_the_fixture(docs, texts, spark):
    labels = [(i, i % 3 == 0, i % 7 == 0) for i, _, _ in texts]
    frame = spark.createDataFrame([(i, int(q), int(t)) for i, q, t in labels], "doc_id long, quality int, toxic int")
    got = sorted(map(tuple, audit.audit(audit.failures(docs), frame).collect()))
    assert got == expected([(i, t, s) for i, t, s in texts], labels)


def test_no_rows_and_no_labels(spark, empty_docs):
    docs, labels = frames(spark)
    assert audit.audit(audit.failures(empty_docs), labels).collect() == []
    none = audit.audit(audit.failures(docs), labels.limit(0)).where("good_lost > 0 or toxic_lost > 0")
    assert none.collect() == []


@pytest.mark.parametrize("shard_bytes", [1, 2000, 1 << 20])
def test_matrix_has_one_number_per_word(spark, docs, texts, shard_bytes):
    """Entries, read back through the numbers of their words, are the counts of every text."""
    rows = docs.select(F.col("doc_id").alias("row"), "text")
    shards = audit.term_matrix(rows, 3, shard_bytes).collect()
    counted = {i: Counter((t or "").encode().split()) for i, t, _ in texts}
    seen, numbers = {}, {}
    for shard in shards:
        for k, row in enumerate(shard.rows):
            span = slice(shard.starts[k], shard.starts[k + 1])
            seen[row] = dict(zip(shard.columns[span], shard.counts[span]))
            assert len(seen[row]) == shard.starts[k + 1] - shard.starts[k]
    assert seen.keys() == counted.keys()
    # A word's number is what all texts that hold it share: words seen in the same texts as often are told apart by none.
    where = {}
    for row, entries in seen.items():
        for number, n in entries.items():
            where.setdefault(number, {})[row] = n
    for row, entries in counted.items():
        for word, n in entries.items():
            numbers.setdefault(word, {})[row] = n
    assert sorted(map(repr, (sorted(x.items()) for x in where.values()))) == sorted(
        map(repr, (sorted(x.items()) for x in numbers.values())))
