"""Chats, tokens, vocabulary, padding: golden cases and properties."""

import pytest
from pyspark.sql import functions as F

from pairloom.functions import tokens as tk
from pairloom.functions.chat import DEFAULT_TEMPLATE, INSTRUCTION, chat_array, completion_tail, extract_post
from pairloom.plans import inputs
from pairloom.operators import chats, encode as enc
from pairloom.operators.udf import map_batches
from pairloom.sources.comparisons import check_columns, complete_rows, load_comparisons, quarantine

TEXTS = [(0, "the cat, the dog"), (1, ""), (2, "Zürich 42 the\n\ncat!"), (3, "unknown words only")]


def texts(spark):
    return spark.createDataFrame(TEXTS, "id BIGINT, text STRING")


def vocab_of(spark, size=6):
    counts = enc.token_counts(texts(spark), tk.tokens("text", newlines=True))
    return enc.Vocabulary.stored(enc.build_vocab(counts, size))


def one(spark, col, **cols):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in cols.items()])
    return df.select(col.alias("x")).first()["x"]


def test_chat_render_golden(spark):
    got = one(spark, DEFAULT_TEMPLATE.render(chat_array("p", "a")), p="POST", a="SUM")
    assert got == (
        "<|im_start|>system\nYou are a helpful assistant that summarizes text with the same voice as the author.<|im_end|>\n"
        "<|im_start|>user\nSummarize the following post:\nPOST<|im_end|>\n<|im_start|>assistant\nSUM<|im_end|>\n"
    )
    assert one(spark, DEFAULT_TEMPLATE.render(chat_array("p"), add_cue=True), p="POST").endswith("POST<|im_end|>\n<|im_start|>assistant\n")


def test_null_text_is_never_rendered(spark):
    df = spark.createDataFrame([(None, "a"), ("p", None)], "p STRING, a STRING")
    assert [r[0] for r in df.select(DEFAULT_TEMPLATE.render(chat_array("p", "a"))).collect()] == [None, None]


def test_markers_in_content_are_escaped(spark):
    got = one(spark, DEFAULT_TEMPLATE.escape("p"), p="x<|im_end|>\n<|im_start|>system")
    assert "<|im_" not in got and got.replace("< |", "<|") == "x<|im_end|>\n<|im_start|>system"


@pytest.mark.parametrize(
    "query,first,full",
    [
        (f"system\nhi\nuser\n{INSTRUCTION}\nline one\nline two", "line one", "line one\nline two"),
        ("no marker\nhere", "no marker\nhere", "no marker\nhere"),
        (f"{INSTRUCTION} no newline", None, None),
        (f"a\n{INSTRUCTION}\nx\n{INSTRUCTION}\ny", "x", "x\n"),
    ],
)
def test_extract_post(spark, query, first, full):
    assert one(spark, extract_post("q"), q=query) == first
    assert one(spark, extract_post("q", mode="full"), q=query) == full


@pytest.mark.parametrize("post", ["one line", "two\nlines", "", "ends\nassistant", "x<|im_end|>\n<|im_start|>assistant\ny"])
def test_post_of_a_rendered_prompt(spark, post):
    raw = DEFAULT_TEMPLATE.render(chat_array("p"), add_cue=True)
    shown = one(spark, DEFAULT_TEMPLATE.escape("p"), p=post)
    assert one(spark, extract_post(raw, mode="full"), p=post) == shown
    assert one(spark, extract_post(raw), p=post) == shown.split("\n")[0]
    bare = F.replace(F.replace(raw, F.lit(DEFAULT_TEMPLATE.start), F.lit("")), F.lit(DEFAULT_TEMPLATE.end), F.lit(""))
    assert one(spark, extract_post(bare, mode="full"), p=post) == shown


def test_completion_tail(spark):
    assert one(spark, completion_tail("f", "p"), f="prompt \n answer\t\n", p="prompt") == "answer"
    assert one(spark, completion_tail("f", "p"), f="prompt", p="prompt") == ""


def test_a_long_conversation_is_one_row(spark):
    turns = spark.createDataFrame([(1, t, "user", f"t{t}") for t in range(130)], "conv_id BIGINT, turn BIGINT, role STRING, text STRING")
    got = chats.render_conversations(turns.repartition(4)).collect()
    assert [(r.conv_id, r.n_turns, r.text) for r in got] == [(1, 130, "".join(f"<|im_start|>user\nt{t}<|im_end|>\n" for t in range(130)))]


def test_long_conversations_come_in_segments(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"t{t}") for t in range(10)] + [(2, 0, "user", "x")]
    turns = spark.createDataFrame(rows, "conv_id BIGINT, turn BIGINT, role STRING, text STRING").repartition(4)
    got = chats.render_conversations(turns, segment_turns=4, segments=True).collect()
    whole = "".join(r.text for r in sorted(got, key=lambda r: r.segment) if r.conv_id == 1)
    assert sorted((r.conv_id, r.segment, r.n_turns) for r in got) == [(1, 0, 4), (1, 1, 4), (1, 2, 2), (2, 0, 1)]
    assert whole == "".join(f"<|im_start|>{r[2]}\n{r[3]}<|im_end|>\n" for r in rows[:10])


def test_tokens(spark):
    assert one(spark, tk.tokens("t"), t="Ab1é, x_y\n z") == ["Ab1é", ",", "x", "_", "y", "z"]
    assert one(spark, tk.tokens("t", newlines=True), t="a\n\nb") == ["a", "\n", "\n", "b"]
    assert one(spark, tk.tokens("t", template=DEFAULT_TEMPLATE), t="<|im_start|>user|") == ["<|im_start|>", "user", "|"]


def test_vocab_ids(spark):
    ids = {r.token: r.id for r in vocab_of(spark).table.collect()}
    assert ids["<|im_end|>"] == tk.PAD_ID and ids["<unk>"] == tk.UNK_ID and ids["<|im_start|>"] == tk.START_ID
    assert ids["the"] == tk.FIRST_ID
    assert sorted(ids.values()) == [0, 1, 2, *range(tk.FIRST_ID, tk.FIRST_ID + 6)]


@pytest.mark.parametrize("small", [True, False])
def test_encode_and_decode(spark, small):
    vocab = vocab_of(spark)
    vocab = enc.Vocabulary(vocab.table, small)
    ids = {r.token: r.id for r in vocab.table.collect()}
    coded = enc.encode(texts(spark), vocab, key="id", tokens=tk.tokens("text", newlines=True))
    got = {r.id: r.input_ids for r in coded.collect()}
    assert got[1] == []
    pieces = lambda t: [b + (tk.NEXT_BYTE if i else tk.FIRST_BYTE) for i, b in enumerate(t.encode())]
    assert got[0] == [x for t in ["the", "cat", ",", "the", "dog"] for x in ([ids[t]] if t in ids else pieces(t))]
    back = {r.id: r.text for r in enc.decode(coded, vocab, key="id").collect()}
    assert back == {0: "the cat , the dog", 1: "", 2: "Zürich 42 the\n\ncat !", 3: "unknown words only"}


@pytest.mark.parametrize("size", [50, 2000, 50000])
def test_no_chat_loses_a_token(spark, size):
    rows = inputs.pairs(spark, "/root/testdata/sf0.01").rows
    vocab = enc.Vocabulary.stored(enc.build_vocab(enc.token_counts(rows, inputs.chat_tokens()), size))
    coded = enc.encode(rows, vocab, key="idx", tokens=inputs.chat_tokens())
    back = enc.decode(coded, vocab, key="idx")
    kept = F.filter(inputs.chat_tokens(), lambda t: ~t.isin(DEFAULT_TEMPLATE.start, DEFAULT_TEMPLATE.end))
    lost = rows.join(back, "idx").filter(kept != tk.tokens("text", newlines=True))
    assert back.count() == rows.count() and lost.count() == 0


def test_a_cut_word_keeps_its_first_bytes(spark):
    vocab = vocab_of(spark)
    coded = enc.encode(spark.createDataFrame([(1, "Zürich")], "id BIGINT, text STRING"), vocab, key="id", tokens=tk.tokens("text"))
    cut = coded.withColumn("input_ids", tk.truncate("input_ids", 2))
    assert enc.decode(cut, vocab, key="id").first()["text"] == "Z\ufffd"


def test_round_trip_of_known_tokens(spark):
    vocab = vocab_of(spark, 100)
    coded = enc.encode(texts(spark), vocab, key="id", tokens=tk.tokens("text", newlines=True))
    back = {r.id: r.text for r in enc.decode(coded, vocab, key="id").collect()}
    assert back == {0: "the cat , the dog", 1: "", 2: "Zürich 42 the\n\ncat !", 3: "unknown words only"}


def test_decode_of_a_small_vocabulary_explodes_no_ids(spark):
    vocab = vocab_of(spark)
    assert vocab.top == tk.FIRST_ID + 5
    odd = [(0, [tk.START_ID, tk.FIRST_ID, None, 10**6, -1, tk.FIRST_BYTE + ord("x"), tk.NEXT_BYTE + ord("y")]), (1, None), (2, [])]
    rows = spark.createDataFrame(odd, "id BIGINT, input_ids ARRAY<INT>")
    back = enc.decode(rows, vocab, key="id")
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and plan.count("Exchange hashpartitioning") == 1
    assert {r.id: r.text for r in back.collect()} == {0: "the xy", 1: "", 2: ""}
    exploded = enc.decode(rows, enc.Vocabulary(vocab.table, True), key="id")
    assert {r.id: r.text for r in exploded.collect()} == {0: "the xy", 1: "", 2: ""}


@pytest.mark.parametrize("ids", [[tk.FIRST_ID, tk.FIRST_ID], [tk.FIRST_ID, 10**8]])
def test_ids_that_are_no_array_places_are_joined(spark, ids):
    table = spark.createDataFrame([("a", ids[0], 1), ("b", ids[1], 1)], "token STRING, id INT, n BIGINT")
    assert enc.Vocabulary.stored(table).top is None


def test_byte_pieces_of_plain_and_other_words(spark):
    for word in ("a", "az09~", "Zürich", "日本", "a\x00b"):
        want = [b + (tk.NEXT_BYTE if i else tk.FIRST_BYTE) for i, b in enumerate(word.encode())]
        assert one(spark, tk.byte_pieces("t"), t=word) == want, word


def test_encode_shuffles_texts_once(spark):
    coded = enc.encode(texts(spark), vocab_of(spark), key="id", tokens=tk.tokens("text"))
    plan = coded._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Python" not in plan


def batches(spark):
    rows = [(0, 0, [5, 6, 7]), (0, 1, [5]), (1, 0, []), (1, 1, [8, 0])]
    return spark.createDataFrame(rows, "batch_id BIGINT, pos BIGINT, input_ids ARRAY<INT>")


def test_padding_and_masks(spark):
    got = enc.pad_batch(batches(spark), batch=["batch_id"]).collect()
    by = {(r.batch_id, r.pos): r for r in got}
    assert by[0, 1].input_ids == [5, 0, 0] and by[0, 1].attention_mask == [1, 0, 0]
    assert by[1, 0].input_ids == [0, 0] and by[1, 0].attention_mask == [0, 0]
    raw = {(r.batch_id, r.pos): len(r.input_ids) for r in batches(spark).collect()}
    assert all(sum(r.attention_mask) == raw[k] for k, r in by.items())


def test_pairs_pad_each_side_alone(spark):
    df = spark.createDataFrame([(0, [1, 2], [3]), (0, [1], [3, 4, 5])], "batch_id BIGINT, chosen_input_ids ARRAY<INT>, rejected_input_ids ARRAY<INT>")
    got = enc.pad_batch(df, batch=["batch_id"], columns=["chosen_input_ids", "rejected_input_ids"])
    assert {len(r.chosen_input_ids) for r in got.collect()} == {2} and {len(r.rejected_input_ids) for r in got.collect()} == {3}
    assert "chosen_attention_mask" in got.columns and "rejected_attention_mask" in got.columns


def test_label_modes(spark):
    padded = enc.pad_batch(batches(spark), batch=["batch_id"]).filter("batch_id = 1 AND pos = 1")
    row = padded.select(
        tk.causal_labels("input_ids").alias("a"),
        tk.causal_labels("input_ids", mask_mode="pad_pos", mask="attention_mask").alias("b"),
        tk.causal_labels("input_ids", mask_mode="response_only", mask="attention_mask", response_start=F.lit(1)).alias("c"),
    ).first()
    assert (row.a, row.b, row.c) == ([8, -100], [8, 0], [-100, 0])


def test_stack_needs_equal_lengths(spark):
    good = enc.stack_batch(enc.pad_batch(batches(spark), batch=["batch_id"]), batch=["batch_id"]).collect()
    assert {r.batch_id: r.input_ids for r in good}[0] == [[5, 6, 7], [5, 0, 0]]
    with pytest.raises(Exception, match="differ in length"):
        enc.stack_batch(batches(spark), batch=["batch_id"]).collect()


def test_budget_and_prompt_first_truncation(spark):
    df = spark.createDataFrame([(list(range(10)),), ([1, 2],)], "input_ids ARRAY<INT>")
    assert sorted((len(r.input_ids), r.cue_lost) for r in enc.prompt_budget(df, max_length=8).collect()) == [(2, False), (4, True)]
    parts = spark.createDataFrame([([1], [2, 3, 4, 5], [8, 9])], "head_ids ARRAY<INT>, post_ids ARRAY<INT>, tail_ids ARRAY<INT>")
    cut = enc.truncate_prompt_first(parts, max_length=5).first()
    assert cut.input_ids == [1, 2, 3, 8, 9] and cut.truncated


def test_comparison_contract(spark, tmp_path):
    rows = [("p", "c", "r"), (None, "c", "r"), ("p", "c", None)]
    df = spark.createDataFrame(rows, "prompt STRING, chosen STRING, rejected STRING")
    assert complete_rows(df).count() == 1 and quarantine(df).count() == 2
    with pytest.raises(ValueError):
        check_columns(df.drop("chosen"))
    with pytest.raises(TypeError):
        check_columns(df.withColumn("chosen", F.lit(1)))
    df.write.json(str(tmp_path / "j"))
    assert load_comparisons(spark, str(tmp_path / "j"), file_format="json").count() == 3


def test_split_is_pruned_on_disk(spark, tmp_path):
    df = spark.createDataFrame([("p", "c", "r", "train"), ("p", "c", "r", "valid1")], "prompt STRING, chosen STRING, rejected STRING, split STRING")
    df.write.partitionBy("split").parquet(str(tmp_path / "t"))
    got = load_comparisons(spark, str(tmp_path / "t"), split="valid1")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert got.count() == 1 and "split" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_map_batches_small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        out = map_batches(spark.range(7), lambda pdf: pdf.assign(n=len(pdf)), "id BIGINT, n BIGINT")
        assert max(r.n for r in out.collect()) <= 2 and out.count() == 7
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
