"""Languages, the suffix tree, personal data, licenses, main texts and the pipeline."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleanspark.llm import language, licenses, personal_data, suffix_tree, wrappers
from gleanspark.llm.queries import op1_personal_data
from tests.llm.conftest import AWKWARD

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SYLLABLES = {"a": ["ba", "lo", "mi", "te"], "b": ["kro", "sch", "ung", "eit"], "c": ["ão", "lh", "çu", "ei"]}


def invented(lang, seed, n=40):
    draw = random.Random(f"{lang}{seed}")
    return " ".join("".join(draw.choice(SYLLABLES[lang]) for _ in range(draw.randint(1, 4))) for _ in range(n))


def held_out(i, folds, held):
    return zlib.crc32(str(i).encode()) % folds == held


def test_languages_on_held_out_rows(documents):
    rows = [(i, invented("abc"[i % 3], i)) for i in range(400)]
    found = language.identify(documents(rows, lang=lambda i: "abc"[i % 3])).collect()
    assert len(found) == 400
    assert {r.doc_id: r.held_out for r in found} == {i: held_out(i, 5, 0) for i in range(400)}
    assert sum(r.lang_pred == "abc"[r.doc_id % 3] for r in found if r.held_out) >= 0.97 * sum(r.held_out for r in found)
    assert all(0 <= r.score <= 1 for r in found)


def test_languages_of_awkward_rows(documents):
    rows = AWKWARD + [(50, "123 !?"), (51, "é")]
    found = language.identify(documents(rows, lang=lambda i: None if i == 51 else "en")).collect()
    by_id = {r.doc_id: r.lang_pred for r in found if r.doc_id is not None}
    assert len(found) == len(rows)
    assert {by_id[i] for i in (7, 3, 9, 50)} == {"und"} and by_id[51] == "en"
    unlabelled = language.identify(documents(rows, lang=lambda i: None)).collect()
    assert {(r.lang_pred, r.score) for r in unlabelled} == {("und", 0.0)}
    assert language.identify(documents([])).count() == 0


def test_kernel_is_one_for_equal_texts_and_folds_into_the_weights():
    texts = [language.letters(invented("abc"[i % 3], i)) for i in range(12)]
    found = language.presence(texts)
    rows = language.scaled(found)
    kernel = rows @ rows.T
    assert np.allclose(np.diag(kernel), 1, atol=1e-5) and kernel.max() <= 1 + 1e-5
    sets = [{t[k : k + 2] for k in range(len(t) - 1)} for t in texts[:2]]
    block = slice(language.BUCKETS, 2 * language.BUCKETS)
    assert abs(int((found[0, block] & found[1, block]).sum()) - len(sets[0] & sets[1])) <= 1


def brute_base(rows):
    words = {i: [w for w in re.split(r"[\x20\x09-\x0D]+", (t or "").translate(LOWER)) if w] + [None] for i, t in rows}
    counts = Counter(w for i, ws in words.items() if not held_out(i, 7, 2) for w in ws)
    n, v = sum(counts.values()), len(counts)
    return {
        i: (len(ws), sum(w in counts for w in ws), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws))
        for i, ws in words.items()
    }


def sentences(n):
    draw = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    return [
        (i, " ".join(draw.choice([draw.choice(words), "new york city", "Of The"]) for _ in range(draw.randint(0, 60)))) for i in range(n)
    ]


@pytest.mark.parametrize("min_share", [1e-5, 2e-2])
def test_base_scores_and_a_better_model(documents, min_share):
    rows = sentences(200)
    found = suffix_tree.language_model_scores(documents(rows), min_share=min_share).collect()
    wanted = brute_base(rows)
    for r in found:
        n_tokens, n_known, total, base = wanted[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (n_tokens, n_known, total, held_out(r.doc_id, 7, 2))
        assert r.base_score == pytest.approx(base, abs=1e-9)
    held = [r for r in found if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_states_give_proper_distributions(spark, documents):
    docs = documents(sentences(150)).select("doc_id", "text")
    counts = suffix_tree._word_counts(docs)
    tree = suffix_tree.learn(docs, counts, min_share=1e-3, min_divergence=1.0)
    assert any(level.state.any() for level in tree.levels)
    # After any two words the chances of all known words and one unknown sum to one.
    for context in ([0, 1], [5, 9], [2, 2]):
        hashes = np.concatenate([np.append(tree.words[context], w) for w in (*tree.words, np.uint64(12345))])
        bounds = np.arange(0, len(hashes) + 1, 3)
        word = suffix_tree._lookup(tree.words, hashes)
        logs = tree.score(hashes, bounds, word)[2::3]
        known = 10.0 ** logs[:-1]
        unknown = 10.0 ** logs[-1] / (tree.tokens + tree.distinct + 1)
        assert len(tree.words) == tree.distinct
        assert known.sum() + unknown == pytest.approx(1.0, abs=1e-9)


def brute_table_scores(rows, min_pair, min_divergence):
    """The scores by states of one word and absolute counts, without any frequent context."""
    words = [[w for w in re.split(r"[\x20\x09-\x0D]+", t.translate(LOWER)) if w] + [None] for _, t in rows]
    training = [ws for (i, _), ws in zip(rows, words) if not held_out(i, 7, 2)]
    counts = Counter(w for ws in training for w in ws)
    pairs = Counter(p for ws in training for p in zip(ws, ws[1:]))
    all_ = sum(counts.values()) + len(counts) + 1
    base = lambda w: (counts[w] + 1) / all_
    states = {}
    for context in counts:
        kept = {b: c for (a, b), c in pairs.items() if a == context and c >= min_pair}
        if kept:
            n = counts[context]
            rest, rest_base = max(1 - sum(kept.values()) / n, 1e-12), max(1 - sum(map(base, kept)), 1e-12)
            divergence = sum(c / n * math.log(c / n / base(b)) for b, c in kept.items()) + rest * math.log(rest / rest_base)
            if divergence * n >= min_divergence:
                states[context] = (kept, n)
    out = {}
    for (i, _), ws in zip(rows, words):
        chances = [base(ws[0])]
        for a, b in zip(ws, ws[1:]):
            if a in states:
                kept, n = states[a]
                own = (kept[b] - suffix_tree.DISCOUNT) / (n + 1) if b in kept else 0
                chances.append(own + (n - sum(c - suffix_tree.DISCOUNT for c in kept.values()) + 1) / (n + 1) * base(b))
            else:
                chances.append(base(b))
        out[i] = sum(map(math.log10, chances))
    return out, states


@pytest.mark.parametrize("min_next, min_divergence", [(0.05, 1.0), (0.001, 20.0), (0.02, 0.0)])
def test_states_of_the_written_table_by_brute_force(documents, min_next, min_divergence):
    rows = sentences(120) + [(1000 + i, f"seldom heard phrase{i // 4} of few Texts " * 2) for i in range(12)]
    # No context makes up all tokens, so that each word is one of the table, some of them travelling with the tasks.
    found = suffix_tree.language_model_scores(documents(rows), min_share=1.0, min_next=min_next, min_divergence=min_divergence)
    wanted, states = brute_table_scores(rows, suffix_tree.MIN_PAIR, min_divergence)
    assert states
    for r in found.collect():
        assert r.score == pytest.approx(wanted[r.doc_id], abs=1e-8)


def test_frequent_pairs_are_kept_whatever_their_share(spark, documents):
    # "the" is followed by 60 words, none of which takes a twentieth of it.
    docs = documents([(i, f"the word{i % 60} ends") for i in range(600)]).select("doc_id", "text")
    counts = suffix_tree._word_counts(docs)
    tree = suffix_tree.learn(docs, counts, min_share=1e-3, min_divergence=1.0)
    assert len(tree.levels[0].pairs) >= 60


def test_scores_of_awkward_rows(documents):
    found = suffix_tree.language_model_scores(documents(AWKWARD)).collect()
    assert len(found) == len(AWKWARD)
    assert all(r.n_tokens == 1 for r in found if r.doc_id in (7, 3, 9))
    assert all(math.isfinite(r.score) and r.score <= 0 for r in found)
    assert suffix_tree.language_model_scores(documents([])).count() == 0


def test_scores_of_repeated_and_null_ids(documents):
    rows = sentences(60)
    rare = [(70, "w1 unseen1 unseen1 unseen2"), (70, "w1 unseen1 unseen1 unseen2"), (70, "w2 unseen3"), (None, "w3 unseen4 w4"), (None, "unseen5")]
    docs = documents(rows + rare)
    # Where 70 is held out nothing is learned from it.
    held = [k for k in range(7) if held_out(70, 7, k)][0]
    found = suffix_tree.language_model_scores(docs, held=held).collect()
    words = [(i, [w for w in re.split(r"[\x20\x09-\x0D]+", t.translate(LOWER)) if w] + [None]) for i, t in rows + rare]
    counts = Counter(w for i, ws in words if i is not None and not held_out(i, 7, held) for w in ws)
    n, v = sum(counts.values()), len(counts)
    wanted = [(i or -1, len(ws), sum(w in counts for w in ws), sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws)) for i, ws in words]
    got = [(r.doc_id or -1, r.n_tokens, r.n_known, r.base_score) for r in found]
    assert [g[:3] for g in sorted(got)] == [w[:3] for w in sorted(wanted)]
    assert [g[3] for g in sorted(got)] == pytest.approx([w[3] for w in sorted(wanted)], abs=1e-9)


def brute_spans(text):
    found = [(m.start(), m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            found.append((m.start(), m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub(r"[^0-9]", "", m.group())
        if 12 <= len(digits) <= 19 and personal_data.luhn(digits):
            found.append((m.start(), m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub(r"[^0-9]", "", m.group())) <= 15:
            found.append((m.start(), m.end(), "phone"))
    return sorted(found, key=lambda s: (s[0], personal_data.KINDS.index(s[2]), s[1]))


def test_base_spans_equal_the_patterns():
    draw = random.Random(1)
    for _ in range(20_000):
        text = "".join(draw.choice("aZ0159..--@@++ ()%é\n") for _ in range(draw.randrange(60)))
        assert personal_data.base_spans(text) == brute_spans(text)


def test_long_runs_take_linear_time():
    draws = ("a" * 200_000 + " @ " + "b" * 200_000, "1234567890 x@y " * 20_000)
    for text in draws:
        personal_data.find_sites([text], [personal_data.base_spans(text)])
    for text in ("a" * 200_000, "1" * 200_000, "1." * 100_000, "+1 " + "(" * 100_000, "a@" * 50_000, "1 " * 50_000):
        personal_data.base_spans(text)


CARD = "4539578763621486"


def test_repeats_of_a_number_get_its_label(documents):
    assert personal_data.luhn(CARD)
    training = [(i, f"pay {CARD[:4]} {CARD[4:8]} {CARD[8:12]} {CARD[12:]} mail a{i}@b.org ip 10.0.0.{i} call +1 (499) 555-6503") for i in range(40)]
    dotted = ".".join(CARD[i : i + 4] for i in range(0, 16, 4))
    text = f"card {CARD} " + "some words between " * 30 + f"again {dotted} end"
    found = {r.doc_id: r for r in personal_data.personal_data(documents(training + [(100, text)])).collect()}
    spans = [(s.kind, text[s.start : s.end]) for s in found[100].spans]
    assert spans == [("card", CARD), ("card", dotted)]
    assert [(s.kind, text[s.start : s.end]) for s in found[100].base] == [("card", CARD)]


def test_personal_data_of_awkward_rows(documents, tmp_path, spark):
    rows = AWKWARD + [(20, "\U0001f34e x@y.de"), (21, f"+1 {CARD}")]
    documents(rows).write.parquet(str(tmp_path / "documents.parquet"))
    found = op1_personal_data(spark, str(tmp_path)).collect()
    texts = dict((i, t) for i, t in rows if i is not None)
    assert len(found) == len(rows)
    for r in found:
        wanted = brute_spans(texts.get(r.doc_id) or "")
        text = ",".join(f"{k}:{a}:{b}" for a, b, k in wanted)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert set(filter(None, text.split(","))) <= set(r.spans.split(","))
    assert personal_data.personal_data(documents([])).count() == 0


PHRASES = {("cc", "by"): "cc-by", ("general", "public", "license"): "gpl", ("all", "rights", "reserved"): "reserved"}


def brute_licenses(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    places = [(i, label) for i in range(len(words)) for p, label in PHRASES.items() if tuple(words[i : i + len(p)]) == p]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def test_license_phrases_and_statements(documents):
    rows = AWKWARD + [
        (30, "CC-BY cc by CC by, general public public license"),
        (31, "All rights reserved. all rights all rights reserved General Public License"),
        (32, "Licensed under the well known Apache License, Version 2.0!"),
        (33, "license general public"),
        (34, "by cc"),
        (35, "cc by " * 500),
    ]
    found = licenses.summary(licenses.license_spans(documents(rows))).collect()
    texts = {i: t for i, t in rows if i is not None}
    assert len(found) == len(rows)
    for r in found:
        if r.doc_id is not None:
            assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_licenses(texts[r.doc_id])
            assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    by_id = {r.doc_id: r for r in found}
    assert by_id[32].labels == "apache-2.0" and by_id[33].labels == by_id[34].labels == ""
    assert sorted(r.n_words for r in found if r.doc_id is None) == [0, 9]
    assert licenses.license_spans(documents([])).count() == 0


def test_statements_with_one_word_changed_added_or_missing(documents):
    rows, wanted = [], {}
    for label, text in licenses.STATEMENTS:
        words = text.split()
        for at in range(1, len(words) - 1):
            for edited in (words[:at] + ["xyz"] + words[at + 1 :], words[:at] + ["xyz"] + words[at:], words[:at] + words[at + 1 :]):
                # LGPL without its "lesser" is the GPL.
                wanted[len(rows)] = "gpl" if label == "lgpl" and "lesser" not in edited else label
                rows.append((len(rows), "before it " + " ".join(edited) + " and after"))
    exact = len(rows)
    rows += [(exact + i, f"this is {text} as said") for i, (_, text) in enumerate(licenses.STATEMENTS)]
    rows += [(1000, "the mit license"), (1001, "released under a mit style permit"), (1002, "the public of the public domain has been")]
    found = {r.doc_id: r for r in licenses.summary(licenses.license_spans(documents(rows))).collect()}
    assert [i for i, label in wanted.items() if label not in found[i].labels.split(",")] == []
    # Of statements alike in all but a word the one that fits best is taken.
    for i, (label, _) in enumerate(licenses.STATEMENTS):
        assert set(found[exact + i].labels.split(",")) - set(found[exact + i].base_labels.split(",")) <= {label}
        assert label in found[exact + i].labels.split(",")
    assert {found[i].labels for i in (1000, 1001, 1002)} == {""}


def test_every_row_is_searched_for_licenses(documents):
    rows = [(None, "code under CC BY here"), (None, "All rights reserved"), (4, "cc by"), (4, "general public license"), (4, "nothing")]
    found = licenses.summary(licenses.license_spans(documents(rows))).collect()
    got = sorted((r.doc_id or -1, r.n_words, r.n_base, r.base_labels) for r in found)
    assert got == [(-1, 3, 1, "reserved"), (-1, 5, 1, "cc-by"), (4, 1, 0, ""), (4, 2, 1, "cc-by"), (4, 3, 1, "gpl")]


def brute_best(spans):
    """Of ``(label, start, words, coverage)`` those that no overlapping one beats in coverage, then in covered words."""
    sizes = {label: [len(t.split()) for name, t in licenses.STATEMENTS if name == label] for label, _ in licenses.STATEMENTS}

    def rank(s):
        # Coverage times a template's size is a whole number of words for the size that fits.
        return s[3], max(round(s[3] * n) for n in sizes[s[0]] if abs(s[3] * n - round(s[3] * n)) < 1e-9)

    meet = lambda a, b: a[1] < b[1] + b[2] and b[1] < a[1] + a[2]
    return [s for s in spans if not any(meet(s, o) and rank(o) > rank(s) for o in spans)]


def test_statements_on_the_same_words_are_settled_as_by_all_pairs(documents):
    draw = random.Random(11)
    texts = [t for _, t in licenses.STATEMENTS]
    rows = []
    for i in range(50):
        words = " ".join(draw.choice([draw.choice(texts), "and then", "released under"]) for _ in range(draw.randint(1, 12))).split()
        rows.append((i, " ".join(w for w in words if draw.random() > 0.06)))
    docs = documents(rows)
    single = {}
    for statement in licenses.STATEMENTS:
        # One template by itself meets no other.
        for r in licenses.license_spans(docs, base=[], statements=[statement]).collect():
            single.setdefault(r.doc_id, []).extend((s.label, s.start, s.words, s.coverage) for s in r.spans)
    found = {r.doc_id: [(s.label, s.start, s.words, s.coverage) for s in r.spans] for r in licenses.license_spans(docs, base=[]).collect()}
    assert sum(map(len, found.values())) > 50
    assert {i: sorted(v) for i, v in found.items()} == {i: sorted(brute_best(v)) for i, v in single.items()}


def test_a_text_of_many_statements_is_settled_in_linear_time(documents):
    import time

    statement = "licensed under the gnu lesser general public license version 3 "
    docs = documents([(1, statement * 10_000), (2, "plain")])
    licenses.summary(licenses.license_spans(docs)).collect()
    begin = time.monotonic()
    found = {r.doc_id: r for r in licenses.summary(licenses.license_spans(docs)).collect()}
    assert time.monotonic() - begin < 10
    assert (found[1].n_words, found[1].n_base, found[1].labels) == (100_000, 10_000, "gpl,lgpl")


def test_license_words_lower_case_a_to_z_alone(documents):
    # The Kelvin sign is no k, and a dotted capital I no i.
    found = licenses.summary(licenses.license_spans(documents([(1, "CC BY \u00c4"), (2, "all r\u0130ghts reserved"), (3, "Released under the MIT licen\u212ae")])))
    assert {r.doc_id: (r.n_words, r.base_labels) for r in found.collect()} == {1: (3, "cc-by"), 2: (3, ""), 3: (5, "")}
    words = documents([(1, "\u212aEY \u00c4B")]).select(licenses.word_list(F.col("text")).alias("w")).first().w
    assert words == ["\u212aey", "\u00c4b"]


def test_license_scan_stays_on_the_jvm(documents):
    plan = licenses.summary(licenses.license_spans(documents(AWKWARD)))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian", plan)


def page(body, nav="home"):
    return (
        f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var x='<p>no</p>';</script></head><body>"
        f"<header><h1>Site</h1></header><nav><ul><li>{nav}<li>more</ul></nav><div class='ad-box'>buy</div><div id='wrap'>{body}</div>"
        "<form><p>search</p></form><div class='comments'><p>reader</p></div><footer><p>&copy; foot</p></footer></body></html>"
    )


@pytest.fixture(scope="module")
def web(spark):
    def make(rows):
        schema = "page_id long, url string, html string, host string, text string, wrapper int"
        return spark.createDataFrame([(*r, "x", "y", 1) for r in rows], schema)

    return make


def test_main_texts(web):
    rows = [(i, f"http://h.example.org/{i}", page(f"<article><h1>Title {i}</h1><p>Par &amp; one\n {i}<br>two<p><b>Last</b> {i}</article>", f"n{i}")) for i in range(8)]
    rows += [(20 + i, f"https://U@k.example.org:8080/{i}", page(f"<div class=body><p>Read {i} {'words ' * 9}</p><p>always the same line</p></div>", f"m{i}")) for i in range(8)]
    rows += [(40, None, page("<p>alone</p>")), (41, "http://h.example.org/odd", "<p>bare &lt;text&gt;")]
    rows += [(42, "http://h.example.org/n", None), (43, "http://e.org", ""), (None, "http://h.example.org/9", rows[0][2]), rows[0]]
    found = wrappers.main_texts(web(rows)).collect()
    assert len(found) == len(rows)
    by_id = {r.page_id: r.text for r in found}
    assert all(by_id[i] == f"Title {i}\n\nPar & one {i} two\n\nLast {i}" for i in range(8)) and by_id[None] == by_id[0]
    assert all(by_id[20 + i].startswith(f"Read {i} words") for i in range(8))
    assert by_id[41] == "bare <text>" and by_id[42] == by_id[43] == ""
    assert all("buy" not in t and "foot" not in t and "reader" not in t and "search" not in t for t in by_id.values())
    assert all(r.n_chars == len(r.text) for r in found)
    assert wrappers.main_texts(web([])).count() == 0


def test_parser_closes_what_html_leaves_open():
    tree = wrappers.parse("<ul><li>a<li>b</ul><p>x<div>y</div><table><tr><td>1<td>2<tr><td>3</table><p")
    assert [c.tag for c in tree.elements()] == ["ul", "p", "div", "table"]
    assert len(tree.elements()[0].elements()) == 2 and len(tree.elements()[3].elements()) == 2


def test_deep_nesting_keeps_its_text():
    page = "<article>" + "".join(f"<div><b>w{i} " for i in range(3000)) + "</article>"
    blocks = wrappers.extract(page, wrappers.induce([page]))
    assert " ".join(blocks).split() == [f"w{i}" for i in range(3000)]


def test_template_of_a_layout_that_few_pages_have(web):
    """Of 150 pages of a host 10 are of a forum, whose constant block no sample of 4 pages needs to hold."""
    rows = [(i, f"http://h.org/{i}", f"<html><body><div class=a><p>Read {i} {'words ' * 9}</p></div></body></html>") for i in range(140)]
    forum = "<html><body><div class=f><p>Post {0} {1}</p><div class=rules><p>Be kind to all others</p></div></div></body></html>"
    rows += [(200 + i, f"http://h.org/{200 + i}", forum.format(i, "said " * 9)) for i in range(10)]
    # A page that is repeated is one page, and not template by that.
    rows += [(300, "http://e.org/1", "<html><body><div class=b><p>Only text of it</p></div></body></html>")] * 6
    found = {r.page_id: r.text for r in wrappers.main_texts(web(rows), sample=4).collect()}
    assert all(found[200 + i] == f"Post {i} " + " ".join(["said"] * 9) for i in range(10))
    assert all(found[i].startswith(f"Read {i} words") for i in range(140)) and found[300] == "Only text of it"


def test_content_of_a_layout_that_few_pages_have(web):
    """Most of a forum page is a text that all forum pages share, which no sample of 16 among 300 pages needs to tell."""
    rows = [(i, f"http://h.org/{i}", f"<html><body><div class=a><p>Read {i} {'words ' * 9}</p></div></body></html>") for i in range(300)]
    forum = "<html><body><div class=f><div class=rules>{1}</div><div class=post><p>Post {0} said</p><p>Reply {0} to it</p></div><div class=by><p>By {0}</p></div></div></body></html>"
    rules = f"<p>Rules of {'this and ' * 99} place</p>"
    rows += [(400 + i, f"http://h.org/{400 + i}", forum.format(i, rules)) for i in range(6)]
    # Pages that declare their article do not hide the others.
    rows += [(500 + i, f"http://h.org/{500 + i}", f"<html><body><div class=a><p>Teaser {i}</p><article><p>Told {i}</p></article></div></body></html>") for i in range(9)]
    found = {r.page_id: r.text for r in wrappers.main_texts(web(rows)).collect()}
    assert all(found[400 + i] == f"Post {i} said\n\nReply {i} to it" for i in range(6))
    assert all(found[i].startswith(f"Read {i} words") for i in range(300)) and all(found[500 + i] == f"Told {i}" for i in range(9))


def test_wrappers_of_tasks_count_as_one_of_all_pages():
    pages = [f"<html><body>{'<div class=top><p>x</p></div>' * (i % 2)}<div><p>Text {i} of it</p></div><ul><li>{i}</ul></body></html>" for i in range(40)]
    whole, parts = wrappers.Slot("#", "#"), [wrappers.Slot("#", "#") for _ in range(4)]
    for i, page in enumerate(pages):
        wrappers._count(whole, [wrappers.parse(page)], 1, True)
        wrappers._count(parts[i % 4], [wrappers.parse(page)], 1, True)
    added = wrappers.Slot("#", "#")
    for part in parts:
        wrappers._add(added, wrappers._counts_from_json(wrappers._counts_to_json(part)))
    assert wrappers._counts_to_json(added) == wrappers._counts_to_json(whole)
    # Slots that hardly a page has leave their text above, so that none is lost to the choice.
    added.pages, before = 1e9, wrappers._varying(added)
    added.children += [wrappers.Slot(f"div.n{i}", "div") for i in range(wrappers.MANY_SLOTS)]
    assert wrappers._varying(wrappers._without_rare(added)) == before and not added.children


def test_end_tags_and_furniture_below_deep_nesting():
    deep = "<font>" * 400 + "".join(f"<div>w{i}</div>" for i in range(50)) + "<nav>menu</nav><aside>beside</aside>"
    page = f"<div class=wrap><article><p>first</p>{deep}</article></div><div class=other><p>not of it</p></div>"
    blocks = wrappers.extract(page, wrappers.induce([page]))
    assert blocks == ["first", *(f"w{i}" for i in range(50))]
    # Neither depth nor unmatched end tags take more than linear time.
    page = "<article>" + "<div>" * 50_000 + "end" + "</b>" * 50_000 + "</article>"
    assert wrappers.extract(page, wrappers.induce([page])) == ["end"]


@pytest.mark.parametrize(
    "before, after",
    [
        ("<body class='has-sidebar'><article>", "</article></body>"),
        ("<div class='content right-sidebar'>", "</div>"),
        ("<div class='right-sidebar'><main>", "</main></div>"),
        ("<div class='page right-sidebar'>", "</div>"),
        ("<article class='post no-comments'>", "</article>"),
        ("<article><section id='social-impact'>", "</section></article>"),
        ("<article><div class='notice'>", "</div></article>"),
        ("<section id='search'>", "</section>"),
    ],
)
def test_words_of_a_class_do_not_drop_the_content(before, after):
    inner = "<h2 id='related-work'>Related work {0}</h2><p>What was found {0} about it.</p>"
    beside = "<div class='sidebar'><p>side</p></div><div class='ad-box'>buy</div>"
    pages = [f"<html>{beside}{before}{inner.format(i)}{after}</html>" for i in range(6)]
    wrapper = wrappers.induce(pages)
    for i, page in enumerate(pages):
        assert wrappers.extract(page, wrapper) == [f"Related work {i}", f"What was found {i} about it."]


def test_links_in_an_article_stay_furniture():
    page = "<article><p>text of it</p><div class='share'><a href=x>tell</a> <a href=y>others</a></div></article>"
    assert wrappers.extract(page, wrappers.induce([page])) == ["text of it"]


def test_pipeline(spark, documents, tmp_path):
    import corpus_pipeline

    item = " ".join(f"item{i}" for i in range(30))
    base = [f"plain{i}" for i in range(100)]
    near = " ".join(base[:50] + ["other"] + base[51:])
    rows = AWKWARD + [(40, " ".join(base)), (41, near), (42, "before " + item), (43, f"{item} " + "clean " * 900), (44, "12 34")]
    documents(rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    found = corpus_pipeline.run(spark, str(tmp_path))
    kept = {r.doc_id for r in found.select("doc_id").distinct().collect()}
    # 43 holds the item in few of its words; the row without id and with a text stays.
    assert kept == {5, 2, 1, 40, 43, None}
    assert found.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert found.where(F.col("doc_id") == 2).count() == 1


def test_pipeline_of_no_rows(spark, documents, tmp_path):
    import corpus_pipeline

    documents([]).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("lang", [lambda i: None, lambda i: "en" if i is not None and held_out(i, 5, 0) else None])
def test_pipeline_without_labels_to_learn_from(spark, documents, tmp_path, lang):
    import corpus_pipeline

    rows = [(i, f"plain text number {i} " + invented("a", i)) for i in range(12)] + [(20, "12 34"), (21, None), (None, "words without an id")]
    documents(rows, lang=lang).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    found = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in found.select("doc_id").distinct().collect()} == {*range(12), None}


# --- probes -----------------------------------------------------------------------------------


def test_long_runs_of_digits_are_no_error(documents):
    texts = ["0" * 5000 + "1.2.3.4", "9" * 6000 + ".1.1.1", "1" * 20_000, "+" + "1-" * 5000 + "1"]
    found = personal_data.personal_data(documents(list(enumerate(texts)))).orderBy("doc_id").collect()
    assert [[(s.kind, s.start, s.end) for s in r.base] for r in found] == [[("ip", 0, 5007)], [], [], []]


def test_alike_numbers_and_addresses_share_an_edge():
    text = "call +44 20 7946 0958 or 020 7946 0958 7; write ann@one.org or ann@two.org; 4111 1111 1111 1111 and 41111111 999"
    sites = personal_data.find_sites([text], [personal_data.base_spans(text)])
    spots = [text[a:b] for a, b in sites.spans]
    linked = {frozenset((spots[a], spots[b])) for a, b in sites.skip}
    assert frozenset(("ann@one.org", "ann@two.org")) in linked
    assert frozenset(("4111 1111 1111 1111", "41111111 999")) in linked
    assert all(a < b for a, b in sites.skip) and len({tuple(e) for e in sites.skip}) == len(sites.skip)


def exact_marginals(model, sites):
    """Label marginals by the sum over all assignments of a small graph."""
    n, k = len(sites.spans), len(personal_data.LABELS)
    own = sites.features @ model.unary
    total = np.zeros((n, k))
    for given in np.ndindex(*(k,) * n):
        logit = sum(own[i, g] for i, g in enumerate(given))
        logit += sum(model.chain[given[a], given[b]] for a, b in sites.chain) + sum(model.skip[given[a], given[b]] for a, b in sites.skip)
        for i, g in enumerate(given):
            total[i, g] += math.exp(logit)
    return total / total.sum(axis=1, keepdims=True)


@pytest.mark.parametrize("text", ["1234567890 x 1234567890", "12345678901, 12345678901 and 1234567899"])
def test_message_passing_is_exact_on_trees_and_near_on_loops(text):
    draw = np.random.default_rng(3)
    k = len(personal_data.LABELS)
    model = personal_data.SkipChain(draw.normal(0, 0.3, (personal_data._FEATURES, k)), draw.normal(0, 0.2, (k, k)), np.eye(k) * 0.4)
    sites = personal_data.find_sites([text], [[]])
    sites.chain = sites.chain[:0] if len(sites.spans) == 2 else sites.chain
    found, exact = model.marginals(sites, 60), exact_marginals(model, sites)
    assert np.abs(found - exact).max() < (1e-6 if len(sites.spans) == 2 else 0.05)


def test_a_label_und_is_a_language_like_any_other(documents):
    rows = [(i, invented("abc"[i % 3], i)) for i in range(300)] + [(900, "12 34"), (901, None)]
    found = language.identify(documents(rows, lang=lambda i: "und" if i is not None and i % 3 == 0 else "b")).collect()
    assert {r.doc_id for r in found if r.no_letters} == {900, 901}
    assert sum(r.lang_pred == "und" for r in found) > 60


def test_languages_are_bounded_together(documents, monkeypatch):
    monkeypatch.setattr(language, "TRAINING_ROWS", 30)
    monkeypatch.setattr(language, "LANDMARKS", 9)
    sizes = []
    solve = language.solve
    monkeypatch.setattr(language, "solve", lambda found, labels, landmarks, ridge: sizes.append((len(found), len(landmarks))) or solve(found, labels, landmarks, ridge))
    rows = [(i, invented("abc"[i % 3], i)) for i in range(300)]
    found = language.identify(documents(rows, lang=lambda i: "abc"[i % 3])).collect()
    assert sizes == [(30, 9)]
    assert sum(r.lang_pred == "abc"[r.doc_id % 3] for r in found) >= 0.9 * len(found)


def test_language_stage_fills_and_filters(spark, documents):
    import corpus_pipeline

    rows = [(i, invented("abc"[i % 3], i)) for i in range(300)] + [(900, "12 34")]
    docs = documents(rows, lang=lambda i: None if i % 10 == 0 else "abc"[i % 3])
    kept = corpus_pipeline.identify_language(spark, docs, "")
    assert kept.columns == docs.columns and kept.schema["lang"].dataType == docs.schema["lang"].dataType
    lang = {r.doc_id: r.lang for r in kept.collect()}
    assert lang.keys() == set(range(300)) and None not in lang.values()
    assert sum(lang[i] == "abc"[i % 3] for i in range(0, 300, 10)) >= 28
    only = corpus_pipeline.identify_language(spark, docs, "", languages=["a"])
    assert 90 <= only.count() <= 110
    assert corpus_pipeline.identify_language(spark, docs, "", min_score=1.1).count() == 0


@pytest.mark.parametrize("frame", ["<form id='aspnetForm' action='/x'>{}</form>", "<form><div class='page'>{}</div></form>"])
def test_a_form_around_the_page_is_no_furniture(spark, frame):
    def page(i):
        body = f"<div class='menu'><a href='/'>Home</a></div><article><h1>Title {i}</h1><p>Text number {i} of the article.</p></article>"
        controls = "<input type='hidden' value='s'><select><option>one</option></select><button>Go</button><form><label>Mail</label></form>"
        return f"<html><body>{frame.format(body + controls)}</body></html>"

    pages = spark.createDataFrame([(i, f"https://h.org/{i}", page(i)) for i in range(12)], "page_id long, url string, html string")
    texts = {r.page_id: r.text for r in wrappers.main_texts(pages).collect()}
    assert texts == {i: f"Title {i}\n\nText number {i} of the article." for i in range(12)}


def test_many_siblings_take_linear_time():
    import time

    page = "<html><body><article>" + "".join(f"<p>Text {i}.</p><ul><li>Item {i}</li></ul>" for i in range(6000)) + "</article></body></html>"
    start = time.process_time()
    wrapper = wrappers.induce([page, page.replace("<ul><li>Item 7</li></ul>", ""), page.replace("<p>Text 9.</p>", "<h2>New</h2><p>Text 9.</p>")])
    assert time.process_time() - start < 20
    assert sum(c.tag in ("p", "ul") for c in wrapper.children[0].children[0].children[0].children) >= 12_000


def test_bands_match_as_whole_tables_do(monkeypatch):
    draw = random.Random(2)
    for _ in range(30):
        tags = [draw.choice(["p", "ul", "h2", "div"]) for _ in range(40)]
        slots = [wrappers.Slot(t, t) for t in tags]
        other = [t for t in tags if draw.random() < 0.9]
        found = [[wrappers.Node(t)] for t in other]
        whole = wrappers._match(slots, found, 1)[0]
        total, pairs = wrappers._match_long(slots, found, 1)
        assert total == len(pairs) and all(slots[i].label == found[j][0].label for i, j in pairs)
        assert pairs == sorted(pairs) and len({i for i, _ in pairs}) == len({j for _, j in pairs}) == len(pairs)
        assert total >= 0.9 * whole
