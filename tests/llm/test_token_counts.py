import random

from tokenizers import Tokenizer

from sheetloom.llm.token_counts import CountedText, build, gathered, leaves, redacted, redacted_counts, sums, update
from sheetloom.llm.tokens import default_tokenizer, word_tokens

TOKENIZER = Tokenizer.from_file(default_tokenizer())


def count(text):
    return len(TOKENIZER.encode(text or "", add_special_tokens=False).ids)


def test_edits_equal_counting_anew():
    tokens, rng = word_tokens(default_tokenizer()), random.Random(3)
    for _ in range(150):
        text = "".join(rng.choice(["the", "a", "é's", " ", "  ", "\n", "word", ".", " "]) for _ in range(rng.randint(0, 900)))
        parts = leaves(text)
        assert "".join(parts) == text
        doc = CountedText.restored(text, [len(p) for p in parts], sums(tokens.counts(parts)))
        for _ in range(10):
            at, drop = rng.randint(0, len(text) + 2), rng.choice([0, 1, 3, 50, 700])
            put = "".join(rng.choice("ab é's <>\n\t.,1") for _ in range(rng.choice([0, 1, 5, 600])))
            at = min(at, len(text))
            text = text[:at] + put + text[at + drop:]
            doc.edit(at, drop, put, tokens.counts)
            assert (doc.text, doc.tokens[1], doc.chars[1]) == (text, count(text), len(text))


def test_only_touched_regions_are_encoded():
    tokens = word_tokens(default_tokenizer())
    text = "some words here " * 5000
    parts = leaves(text)
    doc = CountedText.restored(text, [len(p) for p in parts], sums(tokens.counts(parts)))
    doc.edit(40_000, 4, "other", tokens.counts)
    assert 0 < doc.encoded_again < 1000


def test_tables(spark):
    rows = [(1, "alpha beta " * 100), (1, "alpha beta " * 100), (2, None), (None, ""), (3, "x" * 5000)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, tree int")
    state = build(df)
    assert sorted(r.tree[1] for r in state.collect()) == sorted(count(t) for _, t in rows)
    edits = spark.createDataFrame([(1, 1, 0, 5, "gamma delta"), (1, 0, 6, 4, ""), (2, 0, 9, 9, "new text")],
                                  "doc_id long, seq int, at int, drop int, put string")
    after = update(state.join(gathered(edits), "doc_id", "left")).collect()
    first = "gamma delta" + " " + ("alpha beta " * 100)[10:]
    want = {1: first, 2: "new text", None: "", 3: "x" * 5000}
    for r in after:
        assert (r.text, r.n_tokens) == (want[r.doc_id], count(want[r.doc_id]))
    again = update(update(state.join(gathered(edits), "doc_id", "left")).select("doc_id", "text", "leaf_chars", "tree")
                   .join(gathered(edits), "doc_id", "left"))
    assert all(r.n_tokens == count(r.text) for r in again.collect())
    assert build(df.limit(0)).count() == 0


def test_query_equals_plain_counts(spark):
    import re
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    mail = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}")
    phone, address = re.compile(r"\+\d{1,3} \(\d{3}\) \d{3}-\d{4}"), re.compile(r"\b\d{1,3}(?:\.\d{1,3}){3}\b")
    for r in redacted_counts(docs).collect():
        text = texts[r.doc_id]
        assert r.n_tokens == count(text)
        assert r.n_tokens_after == count(address.sub("[address]", phone.sub("[phone]", mail.sub("[mail]", text or ""))))


def test_stored_trees_are_read_and_only_touched_leaves_encoded(spark, tmp_path):
    text = "some words here " * 3000 + "write to someone@example.org now " + "and more words " * 3000
    docs = spark.createDataFrame([(1, text), (2, "plain " * 2000), (3, None), (3, None)], "doc_id long, text string")
    build(docs).write.parquet(str(tmp_path / "trees"))
    trees = spark.read.parquet(str(tmp_path / "trees"))
    found = {r.doc_id: r for r in redacted(trees).collect()}
    assert (found[1].n_tokens, found[1].n_edits) == (count(text), 1)
    assert found[1].n_tokens_after == count(text.replace("someone@example.org", "[mail]"))
    assert 0 < found[1].encoded_again < 1000
    assert (found[2].n_tokens, found[2].n_tokens_after, found[2].encoded_again) == (count("plain " * 2000),) * 2 + (0,)
    # the counts come from the stored trees: a tree that says otherwise is believed
    told = trees.where("doc_id = 2").selectExpr("doc_id", "text", "leaf_chars", "transform(tree, n -> n + 7) as tree")
    assert redacted(told).first().n_tokens == count("plain " * 2000) + 7
