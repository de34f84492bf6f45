"""Fill-in-middle beside a plain version."""

import random
import re

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.brute import sha
from tradewind.llm import middle

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
TEXTS = [None, "", "\n", "\n\n\n", "one line", "a\nb\nc\n", "ü\n日本\n🙂\nx", "has <P> in it\nand more", "<S>", "a <M\n> b", "<\nP>\n", "\r\nx\r\n"]


def plain(doc_id, text):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = sha("7:" + ("" if doc_id is None else str(doc_id)))
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(units)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")):
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if h4 % 100 < 50 else "psm"
    return n, form, len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"


def rows():
    rng = random.Random(3)
    texts = TEXTS + ["".join(rng.choice("ab\nü<>PSM ") for _ in range(rng.randint(1, 60))) for _ in range(200)]
    texts += ["\n".join("wörd " * rng.randint(0, 40) for _ in range(3000)), "x" * 300_000]
    out = [(i, t, "en", "s", 1) for i, t in enumerate(texts)]
    return out + out[5:9] + [(None, "no\nid\n", None, None, None), (None, None, None, None, None)]


def test_like_plain(spark):
    df = spark.createDataFrame(rows(), DOCS).repartition(4)
    for name in ("n", "form", "output", "middle_chars", "h1"):
        df = df.withColumn(name, F.lit("mine"))
    got = middle.restored(middle.fill_in_middle(df))
    assert got.columns == [*df.columns, "fim", "restored"]
    found = got.collect()
    assert len(found) == len(rows())
    for r in found:
        assert tuple(r["fim"]) == plain(r["doc_id"], r["text"])
        assert r["restored"] == (r["text"] or "")
        assert r["n"] == r["form"] == r["h1"] == "mine"
    assert {r["fim"]["form"] for r in found} == {"plain", "psm", "spm"}


def test_rates(spark):
    df = spark.createDataFrame([(i, "a\nb\nc") for i in range(400)], "doc_id long, text string")
    forms = {r["form"]: r["count"] for r in middle.fill_in_middle(df, rate=30, spm=0).groupBy("fim.form").count().collect()}
    assert set(forms) == {"plain", "psm"} and 80 <= forms["psm"] <= 160
    other = middle.fill_in_middle(df, seed=8).select("doc_id", "fim.output").exceptAll(middle.fill_in_middle(df).select("doc_id", "fim.output"))
    assert other.count() > 200


def test_empty_and_clash(spark):
    none = spark.createDataFrame([], DOCS)
    assert middle.restored(middle.fill_in_middle(none)).count() == 0
    with pytest.raises(ValueError, match="fim exists"):
        middle.fill_in_middle(none.withColumn("fim", F.lit(1)))


@given(st.binary(max_size=400), st.data())
def test_exchange_and_its_inverse(data, draw):
    a, b, c = sorted(draw.draw(st.integers(0, len(data))) for _ in range(3))
    buffer = bytearray(data)
    view = np.frombuffer(buffer, np.uint8)
    middle.exchange(view, a, b, c)
    assert bytes(buffer) == data[:a] + data[b:c] + data[a:b] + data[c:]
    middle.exchange(view, a, a + c - b, c)
    assert bytes(buffer) == data


def test_exchange_in_chunks(monkeypatch):
    monkeypatch.setattr(middle, "CHUNK", 3)
    data = bytes(range(101))
    buffer = bytearray(data)
    middle.exchange(np.frombuffer(buffer, np.uint8), 5, 20, 99)
    assert bytes(buffer) == data[:5] + data[20:99] + data[5:20] + data[99:]


@given(st.text(alphabet="a\n<>PSMü", max_size=40), st.integers(0, 10**6))
def test_round_trip(text, doc_id):
    n, form, p, m, output = middle.arrange(text, str(doc_id))
    assert (n, form, p, m, output) == plain(doc_id, text)
    assert middle.restore(output, form) == text
