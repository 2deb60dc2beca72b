"""Personal data against plain regular expressions: arbitrary texts, checks, context, long runs, masking."""

import hashlib
import random
import re

from bazaar.llm import pii

AGREED = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def base(text):
    """(start, kind, end) of the base spans."""
    out = []
    for k, kind in enumerate(pii.BASE):
        for m in re.finditer(AGREED[kind], text or "", re.ASCII):
            d = re.sub("[^0-9]", "", m[0])
            fine = {
                "email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15,
            }[kind]
            if fine:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def joined(found):
    return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in found)


def frame(spark, texts):
    rows = [(i, t, "x", 1, "k") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, row string, found int, kind string").repartition(3)


def checked(spark, texts):
    got = {r.doc_id: r for r in pii.digest(frame(spark, texts)).collect()}
    assert sorted(got) == list(range(len(texts)))
    for i, t in enumerate(texts):
        want = base(t)
        mine = [s for s in got[i].spans.split(",") if s.split(":")[0] in pii.BASE]
        assert ",".join(mine) == joined(want), t
        assert got[i].base_sha256 == hashlib.sha256(joined(want).encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k in pii.BASE] == [sum(w[1] == n for w in want) for n in range(4)]
    return got


def test_arbitrary_texts(spark):
    rng = random.Random(4)
    pieces = ["a", "b.c", "@", ".", "+", "-", " ", "  ", "(", ")", "1", "42", "255", "256", "0001", "4111 1111 1111 1111", "4111-1111 1111-1111", "5500005555555559", "_", "%", "é", "漢", "😀", "\n", "x@y.z", "10.0.0.1", "+1 (743) 555-3824", "378282246310005", "\t"]
    checked(spark, [None, ""] + ["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 40))) for _ in range(1500)])


def test_ends_of_matches(spark):
    checked(spark, ["a@b.c_d@e.f", "a@b.c%d@x.y@z.w", "x@b..c", "1.2.3.4.5.6.7.8", "1.2.3.04005", "99999999999999999999.1.1.1", "+1 2 3", "+123456789012345 6", "4111111111111111 ", "a-4111111111111111-", "41111111111111111111111111111111", "1 4111111111111111", "+49 30 901820.", "é a@b.cd é", "-a@-.-"])


def runs(n):
    return ["1" * n, "1 " * (n // 2), "a" * n, "a." * (n // 2) + "@", "a@" + "b." * (n // 2) + "c", "1." * (n // 2), "+1" + " " * n, "A1" * (n // 2)]


def test_long_runs(spark):
    """Quadratic or recursive matching would not end here (plain expressions are quadratic, so they see short runs)."""
    checked(spark, runs(2000))
    many = " ".join(f"u{i}@mail.example 10.0.{i % 256}.1" for i in range(20_000))
    got = {r.doc_id: [r[f"n_{k}"] for k in pii.BASE] for r in pii.digest(frame(spark, [*runs(300_000), many])).collect()}
    assert got == {0: [0] * 4, 1: [0] * 4, 2: [0] * 4, 3: [0] * 4, 4: [1, 0, 0, 0], 5: [0, 37_500, 0, 0], 6: [0] * 4, 7: [0] * 4, 8: [20_000, 20_000, 0, 0]}


def test_added_kinds(spark):
    texts = [
        "IBAN GB82 WEST 1234 5698 7654 32 paid", "IBAN GB82WEST12345698765432", "IBAN GB83 WEST 1234 5698 7654 32", "XGB82WEST12345698765432",
        "SSN 123-45-6789.", "part 123-45-6789.", "SSN 666-45-6789", "ssn 9123-45-6789", "call (743) 555-3824 now", "code (743) 555-3824 now", "call +1 (743) 555-3824 now", "example iban GB82WEST12345698765432", "example, call 743-555-3824",
    ]
    got = [r.spans for r in pii.digest(frame(spark, texts)).orderBy("doc_id").collect()]
    assert got == ["iban:5:32", "iban:5:27", "", "", "ssn:4:15", "", "", "", "local_phone:5:19", "", "phone:5:22", "iban:13:35", ""]
    scores = {r.doc_id: r.score for r in pii.spans(frame(spark, ["mail me: a@b.cd", "a@b.cd", "version 1.2.3.4", "host 1.2.3.4"])).collect()}
    assert scores[0] > scores[1] and scores[3] > 0.6 > scores[2] and all(0 <= s <= 1 for s in scores.values())


def test_redacted(spark):
    texts = [None, "", "nothing", "é a@b.cd, call 743-555-3824 😀 10.0.0.1", "1.2.3.4@x.yz", "a@b.cd"]
    table = frame(spark, texts)
    got = pii.redacted(table)
    assert got.columns == table.columns
    assert [r.text for r in got.orderBy("doc_id").collect()] == [None, "", "nothing", "é [EMAIL], call [LOCAL_PHONE] 😀 [IP]", "[EMAIL]", "[EMAIL]"]
    assert got.filter("row <> 'x' OR found <> 1 OR kind <> 'k'").count() == 0


def test_repeated_and_no_rows(spark):
    table = frame(spark, ["a@b.cd"]).unionByName(frame(spark, ["a@b.cd x@y.zz"]))
    assert sorted(r.n_email for r in pii.digest(table).collect()) == [1, 2]
    assert pii.digest(table.limit(0)).count() == 0 and pii.redacted(table.limit(0)).count() == 0
    nulls = spark.createDataFrame([(None, "a@b.cd"), (None, None)], "doc_id long, text string")
    assert sorted(r.spans for r in pii.digest(nulls).collect()) == ["", "email:0:6"]
