"""The last word of a text is near an entity like any other."""

from __future__ import annotations

from stocklens.llm import pii


def test_a_term_at_the_end_of_the_text_goes(spark):
    rows = [(i, f"Plain text number {i} here.") for i in range(40)]
    rows += [(100 + i, f"{i} jane.roe@corp.example.com leads Falconproject") for i in range(4)]
    rows += [(200 + i, f"{i} a.b@c.example.org " + "x" * (pii.REACH - 5) + " Otherproject goes on") for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    texts = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert texts[100] == "0 [EMAIL] leads "
    assert "Otherproject" in texts[200]  # cut by the reach
