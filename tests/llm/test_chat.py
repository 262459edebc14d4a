"""Perspective rotation against DuckDB and against a plain Python version."""

from __future__ import annotations

import hashlib

import duckdb
import pyarrow as pa
import pytest

from shoplens.llm import chat
from shoplens.llm.queries import op9_perspective_rotation

SCHEMA = "conv_id long, turn long, role string, text string"


def _plain(rows):
    """{(dialogue, speaker): (turns, own turns, the whole rendering, spans)}"""
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "unknown", hashlib.md5((text or "").encode()).hexdigest(), text or ""))
    out = {}
    for conv, turns in convs.items():
        for speaker in {t[2] for t in turns} - {"system"}:
            text, spans = "", []
            for _, _, role, _, said in sorted(turns):
                text += "<|im_start|>" + ("system" if role == "system" else "assistant" if role == speaker else "user name=" + role) + "\n"
                if role == speaker:
                    spans.append((len(text), len(text) + len(said) + len("<|im_end|>")))
                text += said + "<|im_end|>\n"
            out[conv, speaker] = (len(turns), len(spans), text, spans)
    return out


def _joined(rows):
    """The parts of each view put together; their starts must meet."""
    out = {}
    for r in sorted(rows, key=lambda r: r.part):
        n, own, text, spans = out.get((r.conv_id, r.speaker), (0, 0, "", []))
        assert r.start == len(text)
        out[r.conv_id, r.speaker] = (n + r.n_turns, own + r.n_own_turns, text + r.text, spans + [(m.start, m.end) for m in r.masks])
    return out


ROWS = [
    (1, 0, "system", "be kind"), (1, 1, "ann", "hé 日本"), (1, 2, "bob", ""), (1, 3, "cy", None), (1, 4, "ann", "x" * 5000),
    (2, 0, "system", "alone"), (3, 5, None, "who"), (3, None, "ann", "first"), (3, 5, "ann", "tie"), (3, 5, "ann", "tie"),
    (None, 0, "ann", "no id"), (None, 1, "bob", "no id"), (4, 0, "ann", None),
    *((5, i, "ann" if i % 3 else "bob", f"t{i}") for i in range(200)),
]


@pytest.mark.parametrize("part_turns", [64, 7])
def test_equals_plain_python(spark, monkeypatch, part_turns):
    monkeypatch.setattr(chat, "SUM_BLOCK", 4)
    df = spark.createDataFrame(ROWS, SCHEMA).selectExpr("*", "'x' as speaker", "1 as part", "2 as said", "3 as start", "4 as n").repartition(3)
    rows = chat.perspectives(df, part_turns=part_turns).collect()
    assert _joined(rows) == _plain(ROWS)
    assert all(r.n_turns <= part_turns for r in rows)
    assert len({(r.conv_id, r.speaker, r.part) for r in rows}) == len(rows)
    assert {r.system_text for r in rows} == {""}


def test_later_parts_carry_the_system_turn_and_hot_dialogues_are_spread(spark):
    rows = [(1, i, "system" if i == 0 else ("ann", "bob")[i % 2], f"turn {i}") for i in range(70)]
    rows += [(None, 0, "ann", "same")] * 500 + [(None, None, "bob", str(i)) for i in range(100)]
    got = chat.perspectives(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    assert _joined(got) == _plain(rows)
    for r in got:
        assert r.system_text == ("<|im_start|>system\nturn 0<|im_end|>\n" if r.conv_id == 1 and r.part else "")
        assert r.n_turns <= 64


def test_empty(spark):
    assert chat.perspectives(spark.createDataFrame([], SCHEMA)).count() == 0


def test_equals_sql_on_the_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    got = op9_perspective_rotation(spark, sf)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    want = con.execute(chat.ORACLE_SQL)
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(want.fetchall())


def test_equals_sql_on_long_and_odd_dialogues(spark):
    rows = ROWS + [(6, i // 3, "system" if i == 100 else f"p{i % 4}", f"é{i}") for i in range(300)]
    got = chat.perspectives(spark.createDataFrame(rows, SCHEMA).repartition(4))
    got = got.withColumn("mask_spans", chat.mask_text(got.masks)).drop("masks")
    con = duckdb.connect()
    con.register("conversations", pa.table({n: [r[i] for r in rows] for i, n in enumerate(("conv_id", "turn", "role", "text"))}))
    want = con.execute(chat.ORACLE_SQL)
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(repr, map(tuple, got.select(*names).collect()))) == sorted(map(repr, want.fetchall()))


def test_no_python_in_the_plan(spark):
    plan = op9_perspective_rotation(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
