"""The filter audit against filters that are really applied in every order."""

from __future__ import annotations

import random
import re
from itertools import permutations

from llm_fixtures import documents  # noqa: F401

from veritally.llm import audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def texts(n=70):
    pick = random.Random(4)
    out = []
    for i in range(n):
        words = [f"w{pick.randrange(pick.choice([60, 900]))}" for _ in range(pick.choice([40, 99, 100, 130]))]
        if pick.random() < 0.3:
            words = [w.upper() + "XYZ" for w in words]
        if pick.random() < 0.3:
            words[3] += pick.choice("#$%&*|")
        out.append(pick.choice([" ", "\t", "\x0b", " \n\n"]).join(words))
    return out + [None, "", "", out[0], out[0], out[3], "é" * 30 + "ABC", "\x85" * 3]


def fails(rows):
    found = []
    for key, text, *_ in rows:
        t = text or ""
        words = WORD.findall(t)
        found.append(
            {
                "A": len(words) < 100,
                "B": 100 * len(set(words)) < 80 * len(words),
                "C": 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t),
                "D": any(c in "#$%&*|" for c in t),
                "E": key is not None and any(k is not None and k < key and (x or "") == t for k, x, *_ in rows),
            }
        )
    return found


def audited_by_hand(rows, good, toxic):
    failed, out = fails(rows), {}
    for part in {r[2] or "" for r in rows}:
        mine = [i for i, r in enumerate(rows) if (r[2] or "") == part]
        share = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = set(mine)
            for step, f in enumerate(order, 1):
                gone = {i for i in left if failed[i][f]}
                left -= gone
                share[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left),
                    len(gone),
                    sum(failed[i][f] for i in mine) - len(gone),
                    sum(failed[i][f] and sum(failed[i].values()) == 1 for i in mine),
                    sum(rows[i][0] in good for i in gone),
                    sum(rows[i][0] in toxic for i in gone),
                ]
        for order in permutations("ABCDE"):
            for step, f in enumerate(order, 1):
                out[part, "".join(order), step].append(share[f])
    return out


def test_audit_equals_filters_applied_in_order(spark):
    pick = random.Random(6)
    rows = [(i, t, pick.choice(["en", "de", None, ""]), i % 3) for i, t in enumerate(texts())]
    rows += [(None, rows[0][1], "en", 0), (None, "abc", None, 0), (5, rows[5][1], "fr", 1), (200, "only", "it", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, mask int").repartition(3)
    labels = [(i, pick.choice([0, 1, None]), pick.choice([0, 1, None])) for i in range(0, 60, 2)]
    labels += [(4, 1, 0), (4, 0, 1), (None, 1, 1), (999, 1, 1)]
    given = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = audit.audit_filters(docs, given).collect()
    got = {(r.part, r.filter_order, r.step): list(r[3:]) for r in found}
    assert len(got) == len(found) == 600 * len({r[2] or "" for r in rows})
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    assert got == audited_by_hand(rows, good, toxic)


def test_fields_hold_counts_beyond_32_bits():
    total = 3_000_000_000_000 * audit.packed(0b00011) + (2**62) * audit.packed(0)
    found = audit.unpacked(total)
    order = audit.orders().index("CBADE")
    assert found[order, 1].tolist() == [2**62, 3_000_000_000_000, 0, 0]
    assert found[order, 2].tolist() == [2**62, 0, 3_000_000_000_000, 0]


def test_no_documents_and_no_labels(spark):
    docs = spark.createDataFrame([(1, "x", "en")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.audit_filters(docs.limit(0), labels).collect() == []
    rows = audit.audit_filters(docs, labels).collect()
    assert len(rows) == 600 and all(r.good_lost == r.toxic_lost == 0 for r in rows)
    assert all(r.removed == int(r.filter_order[r.step - 1] == "A") for r in rows)
