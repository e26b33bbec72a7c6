import re
from collections import Counter

from tests.llm.conftest import ODD_TEXTS
from tillwork.llm import repetition


def brute(text, lengths=(5, 6, 7, 8, 9, 10)):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if grams[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    out = {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
           "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered)}
    seen, chars = set(), 0
    for x in lines:
        chars += sum(map(len, re.findall(r"[^\x20\x09-\x0D]+", x))) if x in seen else 0
        seen.add(x)
    out["dup_line_chars"] = chars
    for n in lengths:
        seen, inside = set(), set()
        for i in range(len(w) - n + 1):
            if tuple(w[i:i + n]) in seen:
                inside.update(range(i, i + n))
            seen.add(tuple(w[i:i + n]))
        out[f"dup_{n}_chars"] = sum(len(w[i]) for i in inside)
    limits = repetition.Limits()
    out["base_failed"] = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    out["kept"] = not out["base_failed"] and out["dup_line_chars"] <= limits.lines * out["word_chars"] and all(
        out[f"dup_{n}_chars"] <= share * out["word_chars"] for n, share in limits.ngrams.items())
    return out


def check(docs, texts):
    rows = repetition.coverage(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        expected = brute(texts[r.doc_id])
        assert {k: r[k] for k in expected} == expected, texts[r.doc_id][:80]


def test_documents(documents):
    check(documents, {r.doc_id: r.text for r in documents.collect()})


def test_odd_texts(make):
    line = "this very line has quite a few words of its own in it\n"
    unique = " ".join(f"w{i}" for i in range(40))
    texts = [t for t in ODD_TEXTS if t is None or len(t) < 50000] + [
        line * 3, line + "\n" + line.strip(), "a\nb\r\na\n a\n", unique, f"{unique} {line} {line}",
        unique + "\n" + unique, "\x0b\x0c x", "x | y & <z> $5 #1 100% *"]
    check(make(texts), dict(enumerate(texts)))


def test_empty(make):
    assert repetition.coverage(make([]).limit(0)).count() == 0


def test_slices_do_not_touch():
    texts = ["a b c d e f g h i"] * 4
    found = repetition.measure(texts, (5,))
    assert found["n_repeat_words"].tolist() == [0] * 4 and found["dup_5_chars"].tolist() == [0] * 4
