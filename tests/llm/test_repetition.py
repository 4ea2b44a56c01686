"""Repetition coverage against counters of tuples."""

import re
from collections import Counter

from llm_util import SF, awkward, empty

from venuelens.llm import repetition as R


def spec(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    later = [x for i, x in enumerate(lines) if x in lines[:i]]

    def covered(n):
        grams = [tuple(words[i: i + n]) for i in range(len(words) - n + 1)]
        count = Counter(grams)
        return {i + j for i, g in enumerate(grams) if count[g] > 1 for j in range(n)}, count

    out = {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
        "n_dup_lines": len(later), "n_repeat_words": len(covered(3)[0]), "n_lines": len(lines),
        "dup_line_chars": sum(len(re.sub(r"[\x20\x09-\x0D]", "", x)) for x in later),
    }
    for n in R.DUPLICATE_SHARE:
        out[f"dup_chars_{n}"] = sum(len(words[i]) for i in covered(n)[0])
    for n in R.TOP_SHARE:
        out[f"top_chars_{n}"] = max((sum(map(len, g)) * c for g, c in covered(n)[1].items() if c > 1), default=0)
    out["base_failed"] = out["n_words"] < 50 or 100 * out["n_repeat_words"] > 50 * out["n_words"]
    chars = out["word_chars"]
    clean = out["dup_line_chars"] <= R.LINE_CHAR_SHARE * chars and out["n_dup_lines"] <= R.LINE_SHARE * out["n_lines"]
    clean = clean and all(out[f"dup_chars_{n}"] <= s * chars for n, s in R.DUPLICATE_SHARE.items())
    clean = clean and all(out[f"top_chars_{n}"] <= s * chars for n, s in R.TOP_SHARE.items())
    out["kept"] = clean and not out["base_failed"]
    return out


def test_query_matches_counters(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in R.QUERIES["op10_repetition_coverage"](spark, SF).collect():
        want = spec(docs[r.doc_id])
        assert {k: r[k] for k in want} == want


def test_awkward_rows(spark):
    df, rows = awkward(spark)
    got = R.judge(R.measure(df)).collect()
    want = [spec(r[1]) for r in rows]
    assert sorted(tuple(r[k] for k in want[0]) for r in got) == sorted(tuple(w.values()) for w in want)
    kept = R.keep(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r[0] for r, w in zip(rows, want) if w["kept"])
    assert R.keep(empty(spark)).count() == 0


def test_clean_labelled_documents_stay(spark):
    got = R.QUERIES["op10_repetition_coverage"](spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id")
    clean = got.where("quality = 1 and not base_failed")
    assert clean.where("kept").count() >= 0.99 * clean.count()


def test_repetition_of_a_quarter_or_a_third_goes(spark):
    def text(share, words=400, passage=20):
        fresh = [f"word{n}" for n in range(words)]
        times = round(share * words / passage)
        again = [f"again{n}" for n in range(passage)]
        parts = fresh[: words - times * passage]
        for n in range(times):
            at = len(parts) * n // times
            parts[at:at] = [" ".join(again)]
        return " ".join(parts)

    rows = [(n, text(share)) for n, share in enumerate((0.0, 0.1, 0.15, 0.27, 0.3, 0.35))]
    got = {r.doc_id: (r.base_failed, r.kept) for r in R.judge(R.measure(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert got == {0: (False, True), 1: (False, True), 2: (False, True), 3: (False, False), 4: (False, False), 5: (False, False)}
