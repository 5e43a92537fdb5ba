"""IBANs before other words, and compact and dashed telephone numbers."""

from corpusmill.llm import pii


def test_ibans_before_words_and_phone_forms(spark):
    values = ["BE68539007547034", "ES9121000418450200051332", "BE68 5390 0754 7034", "NO9386011117947", "+15551234567", "555-123-4567"]
    rows = [(i, f"pay {v} {after}") for i, (v, after) in enumerate((v, a) for v in values for a in ("EUR", "2024", "now"))]
    got = pii.pseudonymize(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()
    missed = [rows[r["doc_id"]][1] for r in got if len(r["pii_kinds"]) != 1 or rows[r["doc_id"]][1].rsplit(" ", 1)[0] in r["text"] or rows[r["doc_id"]][1].split()[-1] != r["text"].split()[-1]]
    print("MISSED", len(missed), "of", len(rows), missed)
    assert not missed
