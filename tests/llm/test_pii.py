import re

import pytest

from reelstat.llm.pii import KINDS, find_private, joined, sanitised

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
TEXTS = [
    "mail a.b@c.de, x@y.zz_q@w.org then a@b.co@d.ef and @no.pe a@b", "é😀 10.0.0.1 256.1.1.1 1.2.3.4.5.6.7.8 000255.1.1.1 9.9.9",
    "4111 1111 1111 1111 and 4111-1111-1111-1112 4111  1111 378282246310005x 12345678901234567890 4111111111111111",
    "+1 (555) 123-4567, +44.20.7946.0958 +123 +1((((((9 +12345678901234567 ++1 555 123 45678", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5",
    "a" * 20_000 + "@" + "b" * 2000 + ".c" * 3000, "7" * 20_000, "1." * 9000, "+1 " + "(" * 5000, " ".join(f"u{i}@h.io" for i in range(800)),
    None, "", "no data", "x@y.zz\nx@y.zz", "4" * 13, "5 " * 18 + "5"]


def luhn(digits):
    return sum(int(c) if k % 2 == 0 else (int(c) * 2 - 9 * (int(c) > 4)) for k, c in enumerate(reversed(digits))) % 10 == 0


def brute(text):
    out = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in m[0].split(".")),
                    "card": lambda: 14 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 10 <= len(digits) <= 15}[kind]():
                out.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(x[2] for x in sorted(out))


def test_base_equals_brute_force(spark):
    docs = spark.createDataFrame([(i, t, "s", "m", "e") for i, t in enumerate(TEXTS)],
                                 "doc_id long, text string, spans string, match string, email_found string")
    found = find_private(docs)
    got = {r["doc_id"]: r["x"] for r in found.select("doc_id", joined(found["base"]).alias("x")).collect()}
    assert got == {i: brute(t) for i, t in enumerate(TEXTS)}


def test_odd_rows(odd, odd_rows, none):
    rows = find_private(odd).collect()
    assert len(rows) == len(odd_rows)
    assert find_private(none).collect() == []
    assert list(KINDS) == list(PATTERNS)


@pytest.fixture(scope="module")
def letters(spark):
    """Quillfeather stands by the same address in different contexts and nowhere else."""
    rows = [(i, f"note {'abcdefghij'[i]}{'klmnopqrst'[i]}{'uvwxyzabcd'[i]}\nwrite to Quillfeather at q{'x' * 3}@corp.example about {w}")
            for i, w in enumerate(["tax", "lunch", "rent", "boats"])]
    rows += [(100 + i, f"plain words write to nobody about {i} at all") for i in range(60)]
    rows += [(300 + i, "a copy of one line: Parrot at single@corp.example today") for i in range(5)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_terms_that_reveal(letters):
    found = {r["doc_id"]: r for r in find_private(letters).collect()}
    text = {r["doc_id"]: r["text"] for r in letters.collect()}
    for i in range(4):
        terms = [text[i][s["start"]:s["end"]] for s in found[i]["spans"] if s["kind"] == "term"]
        assert terms == ["Quillfeather"]                # write, about and the like stand elsewhere too
        assert [s["kind"] for s in found[i]["base"]] == ["email"]
    assert not any(found[100 + i]["spans"] for i in range(60))
    # copies of one context are no evidence
    assert all(s["kind"] == "email" for i in range(5) for s in found[300 + i]["spans"])


def far(i, words=60):
    return " ".join(f"{'abcdefghij'[i % 10]}{'klmnopqrst'[j % 10]}{'uvwxyz'[j % 6]}{'abcdefghij'[j // 10]}" for j in range(words))


def terms_of(df):
    text = {r["doc_id"]: r["text"] for r in df.collect()}
    return {r["doc_id"]: [text[r["doc_id"]][s["start"]:s["end"]] for s in r["spans"] if s["kind"] == "term"]
            for r in find_private(df).collect()}


def test_terms_on_lines_around_and_all_their_occurrences(spark):
    """A name above the address; in document 3 far from it; 50 names another person."""
    name = "Name: Quillfeather\nEmail: q@corp.example\n"
    rows = [(i, f"é😀 {far(i)}\n{name}{far(i + 4)} QUILLFEATHER, quillfeather@corp.example {far(i)}quillfeather.") for i in range(3)]
    rows += [(3, f"Quillfeather {far(3)} {far(3)}\nmail q@corp.example {far(4)}"), (4, f"only q@corp.example {far(5)}")]
    rows += [(20 + i, f"Name: {far(i, 3)} Email: mail only {far(i)}") for i in range(3000)]
    rows += [(10, f"Quillfeather's {far(6)}")]
    got = terms_of(spark.createDataFrame(rows, "doc_id long, text string"))
    for i in range(3):
        assert got[i] == ["Quillfeather", "QUILLFEATHER"]   # no part of an address or of a longer word
    assert got[3] == ["Quillfeather"] and not any(v for k, v in got.items() if k > 3)


def test_cooccurrence_counts_whole_documents(spark):
    """The name stands by the address in 3 of 12 documents that hold both."""
    rows = [(i, f"{far(i)} {'Quillfeather' if i < 3 else 'mail'} q@corp.example {far(i + 1)} {far(i)}\nyours, Quillfeather, {i}")
            for i in range(12)]
    rows += [(100 + i, f"mail and yours {far(i)}") for i in range(200)]
    got = terms_of(spark.createDataFrame(rows, "doc_id long, text string"))
    assert [got[i] for i in range(12)] == [["Quillfeather"] * (2 if i < 3 else 1) for i in range(12)]
    assert not any(got[100 + i] for i in range(200))


def test_sanitised(letters):
    got = {r["doc_id"]: r["text"] for r in sanitised(letters).collect()}
    assert got[0].endswith("write to  at [EMAIL] about tax") and got[100].startswith("plain words")
    assert "Parrot at [EMAIL] today" in got[300] and len(got) == 69
