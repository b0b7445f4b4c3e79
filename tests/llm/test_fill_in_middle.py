import hashlib
import random

import pytest

from kindred.llm.fill_in_middle import MIDDLE, PREFIX, SUFFIX, fill_in_middle, insert, restore, restore_texts, rotate


def plain_version(ident, text):
    """(n, form, prefix_chars, middle_chars, output) by slices of the text."""
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if ident is None else ident}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return len(text), "plain", None, None, text
    a, b = sorted((h1 % (len(text) + 1), h2 % (len(text) + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return len(text), "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return len(text), "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def test_rotations_exchange_blocks_and_undo_themselves():
    draw = random.Random(1)
    for _ in range(300):
        text = draw.randbytes(draw.randint(0, 40))
        low, cut, high = sorted(draw.randint(0, len(text)) for _ in range(3))
        buffer = bytearray(text)
        rotate(buffer, low, cut, high)
        assert buffer == text[:low] + text[cut:high] + text[low:cut] + text[high:]
        rotate(buffer, low, low + high - cut, high)
        assert buffer == text


def test_texts_that_look_like_sentinels_come_back():
    draw = random.Random(2)
    for _ in range(3000):
        text = "".join(draw.choice("<PSM>aé") for _ in range(draw.randint(1, 14))).encode()
        if not any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
            first, second = sorted((draw.randint(0, len(text)), draw.randint(0, len(text))))
            for form in ("psm", "spm"):
                assert restore(bytes(insert(text, first, second, form)), form) == text


def test_every_row_is_that_of_the_plain_version(spark):
    draw = random.Random(3)
    texts = ["".join(draw.choice("abcé日😀 <>\n") for _ in range(draw.randint(0, 60))) for _ in range(800)]
    texts += [None, "", "x", "😀", "a<P>b", "<S>", "<M>", "<P", "long日" * 300_000, "same", "same"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "no id"), (None, None), (5, "again"), (5, "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    made = restore_texts(fill_in_middle(docs)).collect()
    got = sorted(map(str, [(r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in made]))
    assert got == sorted(map(str, [(i, *plain_version(i, t)) for i, t in rows]))
    assert all(r["restored"] == (r["text"] or "") for r in made)
    assert {r["form"] for r in made} == {"plain", "psm", "spm"}


def test_shares_follow_the_parameters(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "'some text to cut' AS text")
    forms = {r["form"]: r["count"] for r in fill_in_middle(docs, cut_percent=50, spm_percent=50).groupBy("form").count().collect()}
    assert abs(forms["plain"] - 2000) < 200 and abs(forms["spm"] - 1000) < 150
    assert fill_in_middle(docs, cut_percent=0).filter("form <> 'plain'").isEmpty()


def test_only_the_output_and_its_form_are_needed(spark):
    rows = [("<P>a<S>c<M>b", "psm"), ("<S>c<P>a<M>b", "spm"), ("<P>as it is", "plain"), ("x", None), (None, None)]
    got = restore_texts(spark.createDataFrame(rows, "output string, form string")).collect()
    assert sorted(r["restored"] for r in got) == ["", "<P>as it is", "abc", "abc", "x"]
    with pytest.raises(Exception, match="not found"):
        restore_texts(spark.createDataFrame([("no sentinel", "psm")], "output string, form string")).collect()
