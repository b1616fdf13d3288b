"""A splitter learned from counts: fewer wrong cuts than the rule on marked texts, defined on nulls, empties and repeats."""

import re

import pytest

from docloom.operators import chunk, sentences

#: Texts whose sentences end at a bar, and nowhere else.
MARKED = [
    "Dr. Ash met Prof. Elm at approx. ten.| The dean left with Dr. Oak.| They were late.",
    "The firm, i.e. Elm and Co. of York, sold approx. nine boats.| Prof. Fir paid for them.| Was it fair?| He thinks so.",
    "Mr. B. Yew and Mrs. C. Yew came (approx. noon).| They saw Prof. Oak, Dr. Fir, etc.| They left.",
    "It went on... and on.| Then it stopped!| No one, e.g. Dr. Elm, knew why.",
    "Mrs. Oak asked Mr. Elm.| He said \"no.\"| Then Mr. Fir agreed with Mrs. Oak, i.e. he paid.",
]
CORPUS = [m.replace("|", "") for m in MARKED] + [
    "Did they see Dr. Ash, Mr. Elm and Mrs. Oak? They did, and so he left. Then the dean paid, e.g. for boats, approx. six of them.",
    "If they go then he goes: Prof. Ash, Dr. Elm, Co. and all, i.e. the firm. It is late, and then no one knew, e.g. Mr. Ash, Mrs. Fir, etc. and so on.",
    "Boats of Elm and Co. were sold to ten late guests, and cars of Fir and Co. too, etc. and then they left. It was noon when they left; was it fair of the firm?",
]


#: The longer a word, the more of it the test wants: "approx" is an abbreviation from some 60 occurrences on here.
COPIES = 20


def wrong(split):
    """Cuts at other places than the bars, and bars without a cut."""
    n = 0
    for m in MARKED:
        wanted = [s.strip() for s in m.split("|")]
        found = [s for s in split(m.replace("|", "")) if s.strip()]
        n += len(set(wanted) ^ set(found))
    return n


@pytest.fixture(scope="module")
def learned(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(CORPUS * COPIES)] + [(900, None), (901, ""), (902, " \n ")], "id long, text string")
    return docs, sentences.learn(docs)


def test_fewer_wrong_cuts_than_the_rule(learned):
    _, splitter = learned
    by_rule, by_counts = wrong(chunk.sentences), wrong(splitter)
    assert by_counts * 4 <= by_rule and by_rule > 30, (by_counts, by_rule)
    abbreviations, openers = splitter.sets
    assert {"dr", "prof", "approx", "mr", "mrs", "i.e", "e.g", "etc"} <= abbreviations and not {"left", "late", "ten", "so"} & abbreviations
    assert "they" in openers and "elm" not in openers


def test_counts_against_a_plain_loop(spark):
    import random

    rng = random.Random(4)
    texts = [" ".join(rng.choice(["Dr.", "ash", "Ash.", "(the", "The", "end!", "x)", "...", "e.g.", "«q»", "Q?”", "7.", "no."]) for _ in range(rng.randint(0, 60))) for _ in range(50)]
    want = {}
    for t in texts:
        before = ""
        for x in t.split():
            core = sentences._OPENING.sub("", x)
            word = sentences._CLOSING.sub("", core).lower()
            starts = not before or bool(re.search("[.!?…][.!?…\"'”’)\\]]*$", before))
            before = x
            if any(c.isalpha() for c in word):
                c = want.setdefault(word, [0] * 5)
                dotted = core.endswith(".") and len(core) > 1 and core[-2] not in ".!?…"
                for i, hit in enumerate((dotted, not dotted, core[0].islower(), core[0].isupper() and starts, core[0].isupper() and not starts)):
                    c[i] += hit
    rows = sentences.counts(spark.createDataFrame([(t, "clash") for t in texts] + [(None, ""), ("", "")], "text string, word string")).collect()
    assert {r.word: list(r)[1:] for r in rows} == want


def test_rows(spark, learned):
    docs, splitter = learned
    rows = sentences.sentences(docs, splitter, "id").collect()
    by = {}
    for r in sorted(rows):
        by.setdefault(r.id, []).append(r.sentence)
    assert set(by) == set(range(len(CORPUS) * COPIES)) and by[0] == by[len(CORPUS)] == list(splitter(CORPUS[0]))
    assert [r.sent_no for r in sorted(rows) if r.id == 0] == [1, 2, 3]
    long = "He saw Dr. Ash. " * 60_000
    one = spark.createDataFrame([(1, long)], "id long, text string")
    assert sentences.sentences(one, splitter, "id").filter("sentence = 'He saw Dr. Ash.'").count() == 60_000
    empty = docs.limit(0)
    alone = sentences.learn(empty)
    assert alone.sets == (frozenset(), frozenset()) and sentences.sentences(empty, alone, "id").count() == 0
    assert list(alone("Was B. Yew here? No... yes. ")) == ["Was B. Yew here?", "No... yes."]


def test_chunks_take_the_splitter(spark, learned):
    docs, splitter = learned
    rows = chunk.chunk_documents(docs.filter("id = 0"), chunk.Words, max_tokens=9, overlap=0, split=splitter).orderBy("chunk_no").collect()
    assert [r.text for r in rows] == ["Dr. Ash met Prof. Elm at approx. ten.", "The dean left with Dr. Oak. They were late."]
