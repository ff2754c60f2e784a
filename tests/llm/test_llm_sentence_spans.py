from __future__ import annotations

import pytest

from corpusflow.llm import sentence_spans
from corpusflow.llm.sentence_spans import cut_sentences, remove_repeated_spans, sentence_runs
from corpusflow.ship import ship_package
from llm_helpers import awkward_rows, docs_frame, prose

PASSAGE = prose(40, 72, 5_000)


def corpus():
    rows = [*awkward_rows()]
    for i in range(12):
        body = [prose(50 + i, 60, 50_000), prose(70 + i, 60, 50_000)]
        rows.append((200 + i, body[0] + "\n" + (PASSAGE if i % 2 else PASSAGE.upper().replace(" ", "  ")) + "\n" + body[1], "en", "a"))
    rows.append((300, PASSAGE + "\n" + PASSAGE + "\n" + prose(90, 30, 50_000), "en", "a"))
    rows.append((301, " ".join(f"u{i}" for i in range(90)), "en", "a"))
    rows.append((302, "v. " + "w. " * 60, "en", "a"))
    return rows


def test_pieces_join_to_the_text():
    for _, text, _, _ in corpus():
        assert "".join(cut_sentences(text or "")) == (text or "")
    assert [len(p.split()) for p in cut_sentences(" ".join(["w"] * 60))] == [25, 25, 10]
    assert cut_sentences("A b. C d!\nE\n\nF? g") == ["A b. ", "C d!\n", "E\n\n", "F? ", "g"]
    assert cut_sentences(" \n ") == [" \n "]


def test_runs_are_the_shortest_with_enough_words():
    text = " ".join("a b c d e f." for _ in range(6))
    assert [(a, b) for _, _, a, b in sentence_runs(text, 2, 12)] == [(i, i + 1) for i in range(5)]
    assert [(a, b) for _, _, a, b in sentence_runs(text, 2, 20)] == [(i, i + 3) for i in range(3)]
    assert sentence_runs("A b c.", 2, 2) == [] and sentence_runs("", 2, 2) == []


@pytest.mark.parametrize("piece", [100_000, 40])
def test_repeated_sentences_equal_brute_force(spark, piece, monkeypatch):
    ship_package(spark)
    monkeypatch.setattr(sentence_spans, "PIECE", piece)
    rows = corpus()
    docs = docs_frame(spark, rows)
    out = {}
    for r in remove_repeated_spans(docs.repartition(5)).collect():
        out.setdefault((r.doc_id, r.n_chars), set()).add(r.text)
    occurrences: dict = {}
    for i, t, _, _ in rows:
        for h, c, a, b in sentence_runs(t or ""):
            occurrences.setdefault((h, c), set()).add((i is None, i or 0, t, a, b))
    gone: dict = {}
    for places in occurrences.values():
        for none, i, t, a, b in sorted(places, key=lambda p: (p[0], p[1], p[3]))[1:]:
            gone.setdefault((None if none else i, t), set()).update(range(a, b + 1))
    for i, t, _, _ in rows:
        drop = gone.get((i, t), set())
        want = t if not drop else "".join(p for k, p in enumerate(cut_sentences(t)) if k not in drop)
        assert want in out[(i, None if t is None else len(t))], i
    kept = {r.doc_id: r for r in remove_repeated_spans(docs).where("doc_id >= 200").collect()}
    assert kept[200].n_removed == 0 and all(kept[200 + i].n_words_removed == 72 for i in range(1, 12))
    assert kept[300].n_words_removed == 144 and kept[301].n_removed == 0


def test_columns_and_rows_stay(spark):
    ship_package(spark)
    docs = docs_frame(spark, awkward_rows())
    out = remove_repeated_spans(docs)
    assert out.columns == [*docs.columns, "n_sentences", "n_removed", "n_words", "n_words_removed"]
    rows = out.collect()
    assert len(rows) == len(awkward_rows())
    texts = {r.doc_id: r.text for r in rows}
    assert texts[3] is None and texts[4] == "" and texts[2] == "" and texts[1]  # of equal texts the first id stays, repeated rows go alike
    assert remove_repeated_spans(docs_frame(spark, [])).count() == 0


def test_passages_without_marks_and_without_spaces(spark):
    """A passage is cut alike wherever it begins, and counted where words have no spaces."""
    ship_package(spark)
    passage = prose(41, 200, 5_000).replace(".", "").lower()
    rows = [(400 + k, " ".join(f"x{k}y{i}" for i in range(3 + 7 * k)) + " " + passage + " " + " ".join(f"z{k}y{i}" for i in range(30)), "en", "a") for k in range(8)]
    signs = "".join(chr(0x4E00 + 7 * i) + ("\u3002" if i % 12 == 11 else "") for i in range(120))
    rows += [(500 + k, chr(0x6000 + k) * 30 + "\u3002" + signs, "zh", "a") for k in range(3)]
    quoted = 'He said "this is the place of it all." (So they went on to the old house by the river.) '
    rows += [(600 + k, f"Number {k} has a start of its own.\n" + quoted * 1 + "And it ended there.", "en", "a") for k in range(3)]
    kept = {r.doc_id: r for r in remove_repeated_spans(docs_frame(spark, rows)).collect()}
    assert kept[400].n_removed == 0 and all(150 <= kept[400 + k].n_words_removed <= 200 for k in range(1, 8))
    assert all(f"x{k}y0" in kept[400 + k].text and f"z{k}y29" in kept[400 + k].text for k in range(8))
    assert kept[500].n_removed == 0 and all(kept[500 + k].n_removed == 10 and kept[500 + k].text == rows[8 + k][1][:31] for k in (1, 2))
    assert cut_sentences(quoted)[0].endswith('all." ')
    assert all(kept[600 + k].text == f"Number {k} has a start of its own.\n" for k in (1, 2))
