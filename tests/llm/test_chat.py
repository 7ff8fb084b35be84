import hashlib
from collections import defaultdict

import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st

from shelflife.llm import chat as C

PARTS = list(C.CONTROLS) + ["\\", "<", "turn>", "#", "a", "\n", "<<turn>", "\\\\", "says"]


@given(st.lists(st.sampled_from(PARTS), max_size=10))
def test_escape_is_reversible_and_leaves_no_mark(parts):
    e = C.Escape(C.CONTROLS)
    text = "".join(parts)
    out = e.escape(text)
    assert e.unescape(out) == text
    assert not any(c in out for c in C.CONTROLS)


def render(source, **names):
    return "".join(p for p, _ in C.Template(source).render(names))


@pytest.mark.parametrize("source,want", [
    ("{{ 'a' ~ 1 + 2 }}", "a3"), ("{{ 2 * (3 + 4) }}", "14"), ("{{ x.k | upper }}", "V"),
    ("{{ x['k'] }}{{ x.none }}", "v"), ("{% if n > 2 and not false %}y{% else %}z{% endif %}", "y"),
    ("{% if n == 1 %}a{% elif n == 3 %}b{% endif %}", "b"),
    ("{% for i in xs %}{{ loop.index }}{{ i }}{% if not loop.last %},{% endif %}{% endfor %}", "1p,2q"),
    ("{% set m = n + 1 %}{{ m }}", "4"), ("a {#- no -#} b", "a  b"), (" {%- if true -%} t {%- endif -%} ", "t"),
    ("{{ 'y' if n < 3 else 'no' }}", "no"), ("{{ 'it\\'s' | trim }}", "it's"),
    ("{{ 'p' in xs }}", "True")])
def test_template(source, want):
    assert render(source, x={"k": "v"}, n=3, xs=["p", "q"]) == want


@pytest.mark.parametrize("source", [
    "{{ x.__class__.__mro__ }}", "{{ x | open }}", "{% import os %}", "{{ f() }}", "{% if a %}",
    "{{ 1 + }}", "{% for in x %}{% endfor %}"])
def test_template_is_sandboxed(source):
    with pytest.raises(C.TemplateError):
        render(source, x="text", f=print)


def test_constants_are_folded():
    t = C.Template("a{{ 'b' ~ 'c' }}{% if 1 == 1 %}d{% else %}{{ x }}{% endif %}{{ 2 * 3 }}")
    assert t.nodes == [("const", "abcd6")]


TURNS = [(1, 0, "system", "s"), (1, 1, "user", "hi </turn>"), (1, 2, "assistant", "yo \\ <says>"),
         (1, 3, "assistant", "again"), (2, 0, "user", None), (2, None, None, "first"),
         (3, 5, "assistant", ""), (3, 5, "assistant", ""), (None, 0, "user", "nobody"),
         (4, 0, "assistant", "x" * 300000), (4, 1, "us\ner", "### Assistant: é\U0001f642")]


def test_round_trip(spark):
    df = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    from pyspark.sql import functions as F
    df = df.withColumn("seq", F.lit(1)).withColumn("formatted", F.lit("x"))
    got = {r.conv_id: r for r in C.format_and_read(df).collect()}
    convs = defaultdict(list)
    for c, t, role, text in TURNS:
        convs[c].append((t is not None, t or 0, role or "", text or ""))
    assert set(got) == set(convs)
    for c, turns in convs.items():
        turns.sort()
        r = got[c]
        said = "".join(f"{role}\n{text}\n" for _, _, role, text in turns)
        loss = "".join(text for _, _, role, text in turns if role == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(turns), hashlib.sha256(said.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    formatted = C.format_conversations(df).collect()
    whole = "".join(r.formatted for r in sorted(formatted, key=lambda r: r.seq) if r.conv_id == 1)
    assert len(whole) == got[1].formatted_chars
    assert len([r for r in formatted if r.conv_id == 1]) == 4  # a row for each turn
    assert C.format_and_read(df.limit(0)).count() == 0


def rendered(turns, monkeypatch):
    """Batches that a rendering task emits for rows in order, with the rows it had read by then."""
    class Rows:
        def mapInArrow(self, run, schema):
            return run

    monkeypatch.setattr(C, "_ordered", lambda convs: Rows())
    read = 0

    def batches():
        nonlocal read
        for i in range(0, len(turns), 1000):
            read += len(turns[i:i + 1000])
            yield pa.RecordBatch.from_pydict(dict(zip(
                ("conv_id", "turn", "role", "text"), map(list, zip(*turns[i:i + 1000])))))
    for b in C.format_conversations(None)(batches()):
        yield b, read


@pytest.mark.parametrize("conv", [7, None])
def test_a_long_conversation_is_emitted_in_bounded_batches(conv, monkeypatch):
    turns = [(conv, i, "assistant" if i % 2 else "user", f"turn {i}") for i in range(30000)]
    got = list(rendered(turns, monkeypatch))
    assert max(b.num_rows for b, _ in got) <= 5000 and got[0][1] < 10000
    rows = [r for b, _ in got for r in b.to_pylist()]
    assert [(r["conv_id"], r["seq"]) for r in rows] == [(conv, i) for i in range(30000)]
    assert "".join(r["formatted"] for r in rows) == "".join(
        f"<turn>{role}<says>{text}</turn>\n" for _, _, role, text in turns)
    assert all(r["formatted"][a:z] == turns[r["seq"]][3] for r in rows for a, z in r["spans"])


def test_long_turns_of_one_conversation_are_emitted_in_bounded_batches(monkeypatch):
    got = list(rendered([(1, i, "user", "x" * 100_000) for i in range(400)], monkeypatch))
    assert max(b.nbytes for b, _ in got) < 5 << 20
    assert sum(b.num_rows for b, _ in got) == 400
