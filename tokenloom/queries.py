"""Registered queries: each reads the given tables in full at ``base``.

Array outputs are reported as md5 fingerprints plus counts so that results
compare across engines; the library functions return the arrays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.chat import render_chat
from .functions.util import md5_ids
from .operators import batches as BT
from .operators import conversations as conv
from .operators import counters as CN
from .operators import encode as enc
from .operators import logs as LG
from .operators import prompts as PR
from .operators import report as RP
from .operators import scoring as SC
from .plans import epochs as P
from .plans import feistel as FE
from .plans import schedule as S
from .plans.ranking import join_on
from .sources import tables as T

# Parameters shared with oracle_sql.py.
L_PRETRAIN = 512
L_SFT = 512
L_DPO = 512
HISTORY = 2
PLAN_EPOCHS = 2
PLAN_BATCH = 16
SHARD_WORLD = 3
SHARD_BATCH = 8
LOG_INTERVAL = 10

REGISTRY: dict = {}


def register(fn):
    REGISTRY[fn.__name__] = fn
    return fn


def _count_not(ids: F.Column, value: int) -> F.Column:
    return F.size(F.filter(ids, lambda t: t != F.lit(value))).cast("bigint")


@register
def pretrain_encode(spark: SparkSession, base: str) -> DataFrame:
    """C1 over every document."""
    out = enc.encode_pretrain(T.pretrain_records(spark, base), max_length=L_PRETRAIN)
    return out.select("sample_id", md5_ids(F.col("input_ids")).alias("ids_md5"),
                      md5_ids(F.col("labels")).alias("labels_md5"),
                      _count_not(F.col("labels"), -100).alias("n_label_tokens"))


@register
def chat_render(spark: SparkSession, base: str) -> DataFrame:
    """K1 + D1: every conversation rendered with the chat template."""
    recs = conv.chat_records(T.turns(spark, base))
    text = render_chat(F.col("messages"))
    return recs.select("conv_id", F.size("messages").cast("bigint").alias("n_messages"),
                       F.octet_length(text).cast("bigint").alias("n_bytes"),
                       F.md5(text).alias("render_md5"))


@register
def sft_encode(spark: SparkSession, base: str) -> DataFrame:
    """Conversations -> fixed-length ids and span labels."""
    recs = conv.chat_records(T.turns(spark, base), max_tokens=L_SFT,
                             min_message_tokens=conv.BYTE_MESSAGE_TOKENS)
    out = enc.encode_sft(recs, id_col="conv_id", tools_col=None, max_length=L_SFT)
    return out.select("conv_id", md5_ids(F.col("input_ids")).alias("ids_md5"),
                      md5_ids(F.col("labels")).alias("labels_md5"),
                      _count_not(F.col("input_ids"), 0).alias("n_tokens"),
                      _count_not(F.col("labels"), -100).alias("n_supervised"))


@register
def sft_supervised_tokens(spark: SparkSession, base: str) -> DataFrame:
    """B10 at token level: every supervised position of every conversation."""
    recs = conv.chat_records(T.turns(spark, base), max_tokens=L_SFT,
                             min_message_tokens=conv.BYTE_MESSAGE_TOKENS)
    out = enc.encode_sft(recs, id_col="conv_id", tools_col=None, max_length=L_SFT)
    return (out.select("conv_id", F.posexplode("labels").alias("pos", "token"))
            .where(F.col("token") != -100)
            .select("conv_id", F.col("pos").cast("bigint").alias("pos"),
                    F.col("token").cast("bigint").alias("token")))


@register
def dpo_pairs(spark: SparkSession, base: str) -> DataFrame:
    """K2: preference pairs built from the conversations."""
    pairs = conv.preference_pairs(T.turns(spark, base))
    return pairs.select("pair_id", F.size("chosen").cast("bigint").alias("n_messages"),
                        F.md5(render_chat(F.col("chosen"))).alias("chosen_md5"),
                        F.md5(render_chat(F.col("rejected"))).alias("rejected_md5"))


@register
def dpo_encode(spark: SparkSession, base: str) -> DataFrame:
    """Both sides encoded, masked and shifted."""
    out = enc.encode_dpo(conv.preference_pairs(T.turns(spark, base), max_tokens=L_DPO,
                                               min_message_tokens=conv.BYTE_MESSAGE_TOKENS), max_length=L_DPO)
    cols = [F.col("pair_id")]
    for side in ("chosen", "rejected"):
        for part in ("x", "y", "mask"):
            cols.append(md5_ids(F.col(f"{part}_{side}")).alias(f"{part}_{side}_md5"))
        cols.append(F.aggregate(f"mask_{side}", F.lit(0).cast("bigint"),
                                lambda a, x: a + x).alias(f"n_mask_{side}"))
    return out.select(*cols)


PLAN_LR = 5e-4
PLAN_ACCUMULATION = 4
SAVE_INTERVAL = 20
RESUME_SAVED = (0, 7, 2)  # (epoch, step, world size) of the saved progress


def _docs(spark: SparkSession, base: str) -> DataFrame:
    """Sample ids only: planning is not CPU-heavy, so no fan-out."""
    return T.table(spark, base, "documents").select(F.col("doc_id").alias("sample_id"))


@register
def epoch_plan(spark: SparkSession, base: str) -> DataFrame:
    """F1 + F4: seeded permutation per epoch, batches of 16, one rank."""
    m = P.build_manifest(_docs(spark, base), PLAN_EPOCHS, 1, PLAN_BATCH)
    return m.select("epoch", "sample_id", "pos", "step", "slot")


@register
def natural_order_plan(spark: SparkSession, base: str) -> DataFrame:
    """natural (id) order, batches of 16."""
    m = P.build_manifest(_docs(spark, base), 1, 1, PLAN_BATCH, shuffle=False)
    return m.select("epoch", "sample_id", "pos", "step", "slot")


def _sharded(spark: SparkSession, base: str, epochs: int) -> DataFrame:
    return P.build_manifest(_docs(spark, base), epochs, SHARD_WORLD, SHARD_BATCH)


@register
def rank_shards(spark: SparkSession, base: str) -> DataFrame:
    """three ranks with wrap padding, batches of 8 per rank."""
    return _sharded(spark, base, 1).select("epoch", "rank", "step", "slot", "pos", "sample_id")


def _resumed(spark: SparkSession, base: str) -> DataFrame:
    epoch, step, saved_world = RESUME_SAVED
    skip = P.rescaled_step(step, saved_world, SHARD_WORLD)
    return P.resume(_sharded(spark, base, PLAN_EPOCHS), epoch, skip)


@register
def resume_plan(spark: SparkSession, base: str) -> DataFrame:
    """E1 + F7: resume after step 7 saved with 2 ranks, now 3 ranks."""
    return _resumed(spark, base).select("epoch", "rank", "step", "slot", "sample_id")


@register
def resume_batch_counts(spark: SparkSession, base: str) -> DataFrame:
    """F5 measured on the resumed manifest: batches and samples per rank."""
    return (_resumed(spark, base).groupBy("epoch", "rank")
            .agg(F.countDistinct("step").cast("bigint").alias("n_batches"),
                 F.count(F.lit(1)).cast("bigint").alias("n_samples")))


@register
def batch_fetch(spark: SparkSession, base: str) -> DataFrame:
    """Planned slots joined to encoded pretrain samples, per batch."""
    m = P.build_manifest(_docs(spark, base), PLAN_EPOCHS, 1, PLAN_BATCH)
    encoded = enc.encode_pretrain(T.pretrain_records(spark, base), max_length=L_PRETRAIN)
    sized = encoded.select("sample_id", _count_not(F.col("labels"), -100).alias("n_label_tokens"))
    return (P.fetch_batches(m, sized).groupBy("epoch", "step")
            .agg(F.count(F.lit(1)).cast("bigint").alias("n_samples"),
                 F.sum("n_label_tokens").cast("bigint").alias("n_tokens"),
                 F.sum("sample_id").cast("bigint").alias("id_sum")))


@register
def batch_fetch_repeated(spark: SparkSession, base: str) -> DataFrame:
    """G4 with ids that are null or repeated: every slot gets one sample, and
    each sample of an id is delivered once an epoch."""
    key = F.when(F.col("doc_id") % 5 != 0, F.floor(F.col("doc_id") / 3).cast("bigint"))
    docs = T.table(spark, base, "documents").select(key.alias("sample_id"), "doc_id", "n_chars")
    m = P.build_manifest(docs.select("sample_id"), PLAN_EPOCHS, 1, PLAN_BATCH)
    name = F.coalesce(F.col("sample_id").cast("string"), F.lit("none")).alias("sample")
    return (P.fetch_batches(m, docs).groupBy("epoch", name)
            .agg(F.count(F.lit(1)).alias("n_slots"), F.countDistinct("pos").alias("n_positions"),
                 F.countDistinct("doc_id").alias("n_samples"), F.sum("n_chars").cast("bigint").alias("n_chars")))


ACCESS_RANK, ACCESS_STEPS = 1, (5, 9)


@register
def rank_steps(spark: SparkSession, base: str) -> DataFrame:
    """F1 + E1 + F6 by random access: what one rank reads in steps 5 to 9 of
    each epoch, without ordering the epoch."""
    docs = FE.with_ordinals(_docs(spark, base))
    n, epochs = docs.count(), list(range(PLAN_EPOCHS))
    slots = FE.rank_slots(spark, n, epochs, SHARD_WORLD, SHARD_BATCH, ACCESS_RANK, *ACCESS_STEPS)
    most = len(epochs) * SHARD_BATCH * (ACCESS_STEPS[1] - ACCESS_STEPS[0] + 1)
    return FE.fetch_steps(slots, docs, most).select("epoch", "rank", "step", "slot", "pos", "sample_id")


@register
def sample_positions(spark: SparkSession, base: str) -> DataFrame:
    """F1 + F7 by random access: where every document stands in each epoch."""
    docs = FE.with_ordinals(_docs(spark, base))
    placed = FE.with_positions(docs, list(range(PLAN_EPOCHS)), docs.count(), SHARD_WORLD, SHARD_BATCH)
    return placed.select("sample_id", "epoch", "rank", "step", "slot", "pos")


@register
def step_calendar(spark: SparkSession, base: str) -> DataFrame:
    """Per step samples, lr, log/save/update flags, update number."""
    n = _docs(spark, base).count()
    iters = F.lit(P.batches_per_rank(n, SHARD_WORLD, SHARD_BATCH))
    cal = P.step_sizes(spark, n, PLAN_EPOCHS, SHARD_WORLD, SHARD_BATCH)
    e, s = F.col("epoch"), F.col("step")
    return cal.select(
        "epoch", "step", "n_samples",
        F.round(S.step_lr(e, s, iters, PLAN_EPOCHS, PLAN_LR) * 1e6, 6).alias("lr_e6"),
        S.is_log_step(s, iters, LOG_INTERVAL).alias("is_log"),
        S.is_save_step(s, iters, SAVE_INTERVAL).alias("is_save"),
        S.is_update_step(s, PLAN_ACCUMULATION).alias("is_update"),
        S.update_number(e, s, iters, PLAN_ACCUMULATION).alias("update_id"))


CE_BATCH = 4


def _scored(spark: SparkSession, base: str) -> DataFrame:
    """Token rows with policy and reference log-probs computed in the scan."""
    t = T.token_scores(spark, base)
    t = SC.with_token_logprob(t, "logits", "label", "logp")
    t = SC.with_token_logprob(t, "ref_logits", "label", "ref_logp")
    return t.drop("logits", "ref_logits")


@register
def token_logprob(spark: SparkSession, base: str) -> DataFrame:
    """H1 per token for both models."""
    return _scored(spark, base).select(
        "seq_id", "pos", F.round("logp", 6).alias("logp"), F.round("ref_logp", 6).alias("ref_logp"))


VOCABULARY_SLICES = 8


@register
def sliced_logprob(spark: SparkSession, base: str) -> DataFrame:
    """H1 from rows that hold an eighth of the vocabulary each."""
    t = T.token_scores(spark, base)
    width = F.ceil(F.size("logits") / VOCABULARY_SLICES).cast("int")
    cut = F.explode(F.transform(F.sequence(F.lit(0), F.lit(VOCABULARY_SLICES - 1)), lambda k: F.struct(
        (k * width).alias("first"), F.slice("logits", k * width + 1, width).alias("part"),
        F.slice("ref_logits", k * width + 1, width).alias("ref_part"))))
    rows = t.select("seq_id", "pos", "label", cut.alias("s")).select("seq_id", "pos", "label", "s.*")
    keys = ["seq_id", "pos"]
    policy = SC.with_state_logprob(SC.slice_states(rows, keys, "part"), "logp")
    reference = SC.with_state_logprob(SC.slice_states(rows, keys, "ref_part"), "ref_logp")
    return SC.align_scores(policy, reference, keys).select(
        "seq_id", "pos", F.round("logp", 6).alias("logp"), F.round("ref_logp", 6).alias("ref_logp"))


@register
def masked_cross_entropy(spark: SparkSession, base: str) -> DataFrame:
    """B13 + H2 + E5: next-token cross-entropy per batch of 4 sequences, from
    model output kept as a token table."""
    from .session import shared_path
    t = SC.stored_targets(SC.token_table(T.token_scores(spark, base), shared_path(spark, "token-table")))
    t = t.withColumn("batch_id", F.floor(F.col("seq_id") / CE_BATCH).cast("bigint"))
    out = SC.masked_cross_entropy(t, ["batch_id"])
    return out.select("batch_id", "n_tokens", F.round("loss", 6).alias("loss"))


@register
def sequence_logprob(spark: SparkSession, base: str) -> DataFrame:
    """Length-normalised log-prob per sequence, both models."""
    out = SC.sequence_logprob(_scored(spark, base), "seq_id", ["logp", "ref_logp"])
    return out.select("seq_id", "n_mask", F.round("logp_avg", 6).alias("policy_avg"),
                      F.round("ref_logp_avg", 6).alias("ref_avg"))


def _margins(spark: SparkSession, base: str) -> DataFrame:
    return SC.reward_margins(SC.pair_logratios(_scored(spark, base)))


@register
def reward_margin(spark: SparkSession, base: str) -> DataFrame:
    """H5/H7: per pair preference logit, rewards and margin."""
    return _margins(spark, base).select(
        "pair_id", F.round("logit", 6).alias("logit"),
        F.round("chosen_reward", 6).alias("chosen_reward"),
        F.round("rejected_reward", 6).alias("rejected_reward"),
        F.round("margin", 6).alias("margin"), F.round("pair_loss", 6).alias("pair_loss"))


@register
def dpo_loss(spark: SparkSession, base: str) -> DataFrame:
    """H6: mean DPO loss (beta 0.1), mean margin and wins over all pairs."""
    out = SC.dpo_summary(_margins(spark, base))
    return out.select("n_pairs", F.round("loss", 6).alias("loss"),
                      F.round("mean_margin", 6).alias("mean_margin"), "n_positive",
                      F.round("accuracy", 6).alias("accuracy"))


@register
def history_prompts(spark: SparkSession, base: str) -> DataFrame:
    """I1 + J1 + J2: prompt with two history messages for every user turn."""
    h = PR.history_messages(T.turns(spark, base), HISTORY)
    prompt = PR.generation_prompt(F.col("messages"))
    ids = PR.prompt_ids(prompt)
    return h.select("conv_id", "turn", F.size("messages").cast("bigint").alias("n_messages"),
                    F.size(ids).cast("bigint").alias("n_tokens"), F.md5(prompt).alias("prompt_md5"))


@register
def pretrain_prompts(spark: SparkSession, base: str) -> DataFrame:
    """J1 (pretrain weights) + J2 over the benchmark items."""
    b = T.table(spark, base, "benchmark")
    ids = PR.prompt_ids(PR.pretrain_prompt(F.col("text")))
    return b.select("item_id", F.size(ids).cast("bigint").alias("n_tokens"),
                    md5_ids(ids).alias("ids_md5"))


@register
def bulk_reply(spark: SparkSession, base: str) -> DataFrame:
    """History prompts through a stand-in predictor (echo of the
    last user message), replies decoded and put behind their user turns."""
    turns = T.turns(spark, base)
    h = PR.history_messages(turns, HISTORY)
    prompts = h.select("conv_id", "turn",
                       PR.prompt_ids(PR.generation_prompt(F.col("messages"))).alias("prompt_ids"))
    out = PR.generate(prompts, PR.echo_predictor_factory)
    replies = out.select("conv_id", "turn", PR.reply_text(F.col("prompt_ids"), F.col("output_ids")).alias("reply"))
    appended = PR.append_replies(turns, replies)
    return appended.select("conv_id", "turn", "role", F.md5("content").alias("reply_md5"),
                           F.octet_length("content").cast("bigint").alias("n_bytes"))


def _answered(turns: DataFrame) -> DataFrame:
    """One round: every user turn's prompt with history, through the stand-in
    model, and its reply put behind it."""
    h = PR.history_messages(turns, HISTORY)
    prompts = h.select("conv_id", "turn",
                       PR.prompt_ids(PR.generation_prompt(F.col("messages"))).alias("prompt_ids"))
    out = PR.generate(prompts, PR.echo_predictor_factory)
    replies = out.select("conv_id", "turn", PR.reply_text(F.col("prompt_ids"), F.col("output_ids")).alias("reply"))
    return PR.insert_replies(turns, replies)


@register
def reply_rounds(spark: SparkSession, base: str) -> DataFrame:
    """J5 + I1 over rounds: two rounds of replies, then the third round's
    prompts (null where a turn isn't the user's)."""
    turns = T.turns(spark, base)
    for _ in range(2):
        turns = _answered(turns)
    h = PR.history_messages(turns, HISTORY).select(
        "conv_id", "turn", F.size("messages").cast("bigint").alias("n_messages"),
        F.md5(PR.generation_prompt(F.col("messages"))).alias("prompt_md5"))
    rows = turns.select("conv_id", "turn", "role", F.md5("content").alias("content_md5"))
    return join_on(rows, h, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", "role", "content_md5", F.coalesce("n_messages", F.lit(0)).alias("n_messages"),
        F.coalesce("prompt_md5", F.lit("")).alias("prompt_md5"))


BATCH_TOKENS = 16_384


@register
def generation_batches(spark: SparkSession, base: str) -> DataFrame:
    """J2 + J3: the documents' prompts in batches of bounded padded size."""
    docs = T.table(spark, base, "documents")
    prompts = docs.select("doc_id", PR.prompt_ids(PR.pretrain_prompt(F.col("text"))).alias("prompt_ids"))
    out = BT.batch_report(BT.pack(prompts, ["doc_id"], BATCH_TOKENS))
    return out.select("*", F.round(1 - F.col("n_tokens") / F.col("n_padded"), 6).alias("pad_share"))


@register
def generation_resumed(spark: SparkSession, base: str) -> DataFrame:
    """J3 over two runs: the first writes some replies, the second adds those
    that are missing; a reply is made once for every prompt."""
    from .session import shared_path
    docs = T.table(spark, base, "documents")
    prompts = docs.select("doc_id", PR.prompt_ids(PR.pretrain_prompt(F.substring("text", 1, 200))).alias("prompt_ids"))
    path = shared_path(spark, "generated")
    for part in (prompts.where(F.col("doc_id") % 3 == 0), prompts):
        out = BT.generate_to(part, ["doc_id"], path, PR.repeat_predictor_factory, BATCH_TOKENS, rounds=2)
    return out.select("doc_id", F.size("output_ids").cast("bigint").alias("n_ids"),
                      F.md5(PR.reply_text(F.col("prompt_ids"), F.col("output_ids"))).alias("reply_md5"))


#: Path of a ``tokenizers`` vocabulary file; None: a public byte-level one.
VOCABULARY: str | None = None


def _vocabulary() -> str:
    if VOCABULARY:
        return VOCABULARY
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@register
def vocab_reply(spark: SparkSession, base: str) -> DataFrame:
    """B2 + J3 + J4 with a real vocabulary: whole documents to its ids, through
    a stand-in model that repeats them, and the new ids back to text."""
    from .operators.vocab import HFTokenizer, tokenize_column
    path = _vocabulary()

    def vocabulary():
        return HFTokenizer(path)

    docs = T.table(spark, base, "documents").select("doc_id", "text")
    prompts = tokenize_column(docs, "text", vocabulary, "prompt_ids").drop("text")
    replies = PR.decode_replies(PR.generate(prompts, PR.repeat_predictor_factory), vocabulary)
    return replies.select("doc_id", F.md5("reply").alias("reply_md5"),
                          F.octet_length("reply").cast("bigint").alias("n_bytes"))


LOG_LR = 5e-4


def _steps(spark: SparkSession, base: str) -> DataFrame:
    return LG.number_steps(T.step_log(spark, base), tiebreak=["event_id"])


@register
def train_log_sample(spark: SparkSession, base: str) -> DataFrame:
    """A6 + E2 + F9 + H8: the logged steps of each run with lr and loss parts."""
    logged = LG.logged_steps(_steps(spark, base), LOG_INTERVAL, LOG_LR)
    aux = F.lit(0.0)  # the step log has no auxiliary loss
    total = SC.total_loss(F.col("loss"), aux)  # H8: logged loss = task + aux
    return logged.select("run", "step", "iters", F.round(total, 6).alias("loss"),
                         F.round(total - aux, 6).alias("logits_loss"),
                         F.round(F.col("lr") * 1e6, 6).alias("lr_e6"))


@register
def train_eta(spark: SparkSession, base: str) -> DataFrame:
    """Elapsed seconds and remaining-minutes estimate at logged steps."""
    logged = LG.logged_steps(_steps(spark, base), LOG_INTERVAL, LOG_LR)
    return logged.select("run", "step", F.round(LG.spent_seconds(), 6).alias("spent_sec"),
                         LG.eta_minutes().alias("eta_min"))


@register
def latest_progress(spark: SparkSession, base: str) -> DataFrame:
    """A7/A8 + F7: latest saved state per run; step rescaled to 2 ranks."""
    steps = _steps(spark, base)
    progress = steps.select("run", F.lit(0).alias("epoch"), "step",
                            (F.lit(1) + F.col("run") % 4).cast("int").alias("world_size"))
    latest = LG.latest_progress(progress)
    return latest.select("run", "epoch", "step", "world_size",
                         F.floor(F.col("step") * F.col("world_size") / 2).cast("bigint").alias("resume_step"))


@register
def length_report(spark: SparkSession, base: str) -> DataFrame:
    """K3 per language at the pretrain length."""
    d = T.table(spark, base, "documents")
    out = RP.length_report(d, ["lang"], L_PRETRAIN)
    return out.select("lang", "n_docs", "total_tokens", F.round("avg_tokens", 6).alias("avg_tokens"),
                      "max_tokens", "median_tokens", "n_truncated", F.round("pad_share", 6).alias("pad_share"))


@register
def length_report_by_quality(spark: SparkSession, base: str) -> DataFrame:
    """K3 sliced by the quality and toxicity labels of labelled documents."""
    d = T.table(spark, base, "documents").join(T.table(spark, base, "labels"), "doc_id")
    out = RP.length_report(d, ["quality", "toxic"], L_PRETRAIN)
    return out.select("quality", "toxic", "n_docs", "total_tokens",
                      F.round("avg_tokens", 6).alias("avg_tokens"), "max_tokens", "median_tokens",
                      "n_truncated", F.round("pad_share", 6).alias("pad_share"))


@register
def stream_encode(spark: SparkSession, base: str) -> DataFrame:
    """K4: C1 as a Structured Streaming job over the documents table; the
    appended Parquet output is read back (must equal pretrain_encode)."""
    from .session import shared_path
    from .streaming.encode_stream import start_append, stream_table
    schema = T.table(spark, base, "documents").schema
    src = stream_table(spark, f"{base.rstrip('/')}/documents.parquet", schema, max_files_per_trigger=64)
    encoded = enc.encode_pretrain(src.select(F.col("doc_id").alias("sample_id"), "text"),
                                  max_length=L_PRETRAIN)
    sink, ckpt = shared_path(spark, "stream-sink"), shared_path(spark, "stream-ckpt")
    q = start_append(encoded, sink, ckpt)
    q.awaitTermination()
    out = spark.read.parquet(sink)
    return out.select("sample_id", md5_ids(F.col("input_ids")).alias("ids_md5"),
                      md5_ids(F.col("labels")).alias("labels_md5"),
                      _count_not(F.col("labels"), -100).alias("n_label_tokens"))


@register
def length_state(spark: SparkSession, base: str) -> DataFrame:
    """K3 from stored counters: two inputs counted one after the other, the
    second twice, and reported from the merged state."""
    from .session import shared_path
    docs, path = T.table(spark, base, "documents"), shared_path(spark, "length-counters")
    for source in (0, 1, 1):
        CN.store_counters(CN.length_counters(docs.where(F.col("doc_id") % 2 == source), ["lang"]), path, str(source))
    out = CN.report_from_counters(CN.stored_counters(spark, path, ["lang"]), ["lang"], L_PRETRAIN,
                                  quantiles=(0.5, 0.9, 0.99))
    return out.select("lang", "n_docs", "total_tokens", F.round("avg_tokens", 6).alias("avg_tokens"), "max_tokens",
                      "n_truncated", F.round("pad_share", 6).alias("pad_share"), "q50_tokens", "q90_tokens", "q99_tokens")


@register
def stream_rejects(spark: SparkSession, base: str) -> DataFrame:
    """K4 + A7: documents as JSON lines, some of them cut off, through a stream
    that encodes the whole ones, keeps the others and writes its progress."""
    from .session import shared_path
    from .streaming import batch_stream as BS
    from .streaming.encode_stream import stream_files
    docs, home = T.table(spark, base, "documents"), shared_path(spark, "stream-batches")
    line = F.when(F.col("doc_id") % 50 == 7, F.concat(F.lit('{"sample_id": '), F.col("doc_id").cast("string"))).otherwise(
        F.to_json(F.struct(F.col("doc_id").alias("sample_id"), "text")))
    docs.select(line.alias("value")).write.text(f"{home}/in")
    raw = stream_files(spark, f"{home}/in", f"sample_id LONG, text STRING, {BS.CORRUPT} STRING", max_files_per_trigger=64)
    BS.start_batches(raw, home, f"{home}/checkpoint", lambda df: enc.encode_pretrain(df, max_length=L_PRETRAIN)
                     ).awaitTermination()
    good = BS.finished(spark, home).select(
        F.lit("sample").alias("kind"), F.col("sample_id").cast("string").alias("name"), md5_ids(F.col("input_ids")).alias("md5"))
    bad = BS.finished(spark, home, "rejects").select(
        F.lit("reject").alias("kind"), F.regexp_extract("line", "[0-9]+", 0).alias("name"), F.md5("line").alias("md5"))
    done = BS.progress(spark, home).agg(F.sum("n_samples").alias("s"), F.sum("n_rejects").alias("r"))
    counts = done.select(F.lit("progress").alias("kind"), F.concat_ws("/", "s", "r").alias("name"), F.lit("").alias("md5"))
    return good.unionByName(bad).unionByName(counts)


@register
def sft_length_report(spark: SparkSession, base: str) -> DataFrame:
    """K3 for the SFT samples at the SFT length."""
    out = RP.sft_length_report(T.turns(spark, base), L_SFT)
    return out.select("n_samples", "total_tokens", "max_tokens", "n_truncated", "n_no_supervised",
                      F.round("supervised_share", 6).alias("supervised_share"))


@register
def training_shards(spark: SparkSession, base: str) -> DataFrame:
    """A5: encoded pretrain samples written per (epoch, rank) in step order
    to the shared folder, read back and summarised per shard."""
    from .session import shared_path
    docs = T.pretrain_records(spark, base)
    m = P.build_manifest(docs.select("sample_id"), 1, SHARD_WORLD, SHARD_BATCH)
    encoded = enc.encode_pretrain(docs, max_length=L_PRETRAIN)
    path = shared_path(spark, "training-shards")
    P.write_training_shards(m, encoded, path)
    back = spark.read.parquet(path)
    return back.groupBy("epoch", "rank").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_samples"),
        F.countDistinct("step").cast("bigint").alias("n_steps"),
        F.sum("sample_id").cast("bigint").alias("id_sum"),
        F.sum(_count_not(F.col("labels"), -100)).cast("bigint").alias("n_tokens"))


DPO_BATCH = 4


@register
def dpo_batch_loss(spark: SparkSession, base: str) -> DataFrame:
    """H6 as a trainer logs it: mean DPO loss per micro-batch of 4 pairs."""
    m = _margins(spark, base).withColumn("batch_id", F.floor(F.col("pair_id") / DPO_BATCH).cast("bigint"))
    out = SC.dpo_summary(m, ["batch_id"])
    return out.select("batch_id", "n_pairs", F.round("loss", 6).alias("loss"),
                      F.round("mean_margin", 6).alias("mean_margin"), "n_positive")


@register
def update_batches(spark: SparkSession, base: str) -> DataFrame:
    """F8: samples per weight update (micro-batch x accumulation x ranks).
    ``complete`` is false for micro-steps after the last update."""
    n = _docs(spark, base).count()
    iters = P.batches_per_rank(n, SHARD_WORLD, SHARD_BATCH)
    steps = P.step_sizes(spark, n, PLAN_EPOCHS, SHARD_WORLD, SHARD_BATCH)
    upd = steps.withColumn("update_id", S.update_group(F.col("epoch"), F.col("step"), F.lit(iters), PLAN_ACCUMULATION))
    done = F.max(S.is_update_step(F.col("step"), PLAN_ACCUMULATION))
    return upd.groupBy("update_id").agg(F.sum("n_samples").alias("n_samples"),
                                        F.count(F.lit(1)).alias("n_micro_steps"), done.alias("complete"))


@register
def score_align(spark: SparkSession, base: str) -> DataFrame:
    """Policy and reference scored as two tables, reduced per sequence,
    then joined."""
    t = T.token_scores(spark, base)
    policy = SC.sequence_logprob(SC.with_token_logprob(t, "logits"), "seq_id", ["logp"])
    ref = SC.sequence_logprob(SC.with_token_logprob(t, "ref_logits", out_col="ref_logp"), "seq_id", ["ref_logp"])
    out = SC.align_scores(policy, ref.drop("n_mask"), ["seq_id"])
    return out.select("seq_id", "n_mask", F.round("logp_avg", 6).alias("policy_avg"),
                      F.round("ref_logp_avg", 6).alias("ref_avg"))


@register
def stack_sides(spark: SparkSession, base: str) -> DataFrame:
    """C3 output stacked to token rows of both sides, summed per side."""
    encoded = enc.encode_dpo(conv.preference_pairs(T.turns(spark, base), max_tokens=L_DPO,
                                                   min_message_tokens=conv.BYTE_MESSAGE_TOKENS), max_length=L_DPO)
    rows = SC.stack_sides(encoded)
    weight = F.col("mask") * F.col("y").cast("bigint") * (F.col("pos") + 1)
    return rows.groupBy("pair_id", "side").agg(F.count(F.lit(1)).alias("n_rows"),
                                               F.sum("mask").cast("bigint").alias("n_mask"),
                                               F.sum(weight).alias("weighted"))


def _through_jsonl(spark: SparkSession, records: DataFrame, name: str) -> str:
    """Write records as JSON lines below the shared folder."""
    from .session import shared_path
    path = shared_path(spark, name)
    records.write.json(path)
    return path


def _counted(encoded: DataFrame, *cols: F.Column) -> DataFrame:
    """Samples without ids: equal ones are counted."""
    out = encoded.select(*cols)
    return out.groupBy(*out.columns).agg(F.count(F.lit(1)).alias("n_rows"))


@register
def jsonl_pretrain(spark: SparkSession, base: str) -> DataFrame:
    """A1 -> C1: documents as JSON lines, read by the pretrain reader."""
    from .sources import jsonl as J
    path = _through_jsonl(spark, T.table(spark, base, "documents").select("text"), "jsonl-pretrain")
    recs = J.with_sample_id(J.checked(J.read_pretrain(spark, path)), "text")
    out = enc.encode_pretrain(recs, max_length=L_PRETRAIN)
    return _counted(out, md5_ids(F.col("input_ids")).alias("ids_md5"), md5_ids(F.col("labels")).alias("labels_md5"))


def _plain_messages(messages: F.Column) -> F.Column:
    return F.transform(messages, lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")))


@register
def jsonl_sft(spark: SparkSession, base: str) -> DataFrame:
    """A2 -> C2: conversations as JSON lines, read by the chat reader."""
    from .sources import jsonl as J
    recs = conv.chat_records(T.turns(spark, base))
    path = _through_jsonl(spark, recs.select(_plain_messages(F.col("messages")).alias("conversations")), "jsonl-sft")
    back = J.with_sample_id(J.checked(J.read_sft(spark, path)), "messages", "tools")
    out = enc.encode_sft(back, max_length=L_SFT)
    return _counted(out, md5_ids(F.col("input_ids")).alias("ids_md5"), md5_ids(F.col("labels")).alias("labels_md5"))


@register
def jsonl_dpo(spark: SparkSession, base: str) -> DataFrame:
    """A3 -> C3: preference pairs as JSON lines, read by the pair reader."""
    from .sources import jsonl as J
    pairs = conv.preference_pairs(T.turns(spark, base))
    path = _through_jsonl(spark, pairs.select(*[_plain_messages(F.col(c)).alias(c) for c in ("chosen", "rejected")]),
                          "jsonl-dpo")
    back = J.with_sample_id(J.checked(J.read_dpo(spark, path)), "chosen", "rejected")
    out = enc.encode_dpo(back.withColumnRenamed("sample_id", "pair_id"), max_length=L_DPO)
    return _counted(out, *[md5_ids(F.col(f"{part}_{side}")).alias(f"{part}_{side}_md5")
                           for side in ("chosen", "rejected") for part in ("x", "y", "mask")])


CHAT_TOOL = '{"name": "lookup"}'
CHAT_SYSTEM = "Be brief."


def _tool_turns(spark: SparkSession, base: str) -> DataFrame:
    """Turns with tool calls, tool replies, an unknown role and absent content
    by fixed rules on conversation and turn."""
    k = F.col("conv_id") + F.col("turn")
    role = (F.when(k % 11 == 0, "observer").when((F.col("role") == "user") & (k % 5 < 2), "tool")
            .when((F.col("role") == "assistant") & (k % 13 == 0), "tool").otherwise(F.col("role")))
    t = T.turns(spark, base).withColumn("role", role).withColumn("content", F.when(k % 7 != 0, F.col("content")))
    call = F.struct(F.lit("lookup").alias("name"),
                    F.concat(F.lit('{"turn": '), F.col("turn").cast("string"), F.lit("}")).alias("arguments"))
    calls = F.when((F.col("role") == "assistant") & (F.col("turn") % 4 == 1), F.array(call, call))
    return t.withColumn("tool_calls", calls)


@register
def chat_tools(spark: SparkSession, base: str) -> DataFrame:
    """Tools, tool calls, runs of tool replies, unknown roles,
    absent content and the tail without thinking."""
    from .functions.chat import MESSAGES_TYPE, choose_tools
    entries = F.array_sort(F.collect_list(F.struct("turn", "role", "content", "tool_calls")))
    recs = _tool_turns(spark, base).groupBy("conv_id").agg(entries.alias("_t"))
    own = F.transform("_t", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"),
                                               x["tool_calls"].alias("tool_calls"))).cast(MESSAGES_TYPE)
    system = F.array(F.struct(F.lit("system").alias("role"), F.lit(CHAT_SYSTEM).alias("content"),
                              F.lit(None).alias("tool_calls"))).cast(MESSAGES_TYPE)
    kind = F.col("conv_id") % 3
    messages = F.when(kind < 2, F.concat(system, own)).otherwise(own)
    # Tools are listed for all; only a leading system message makes them count.
    functions = F.when(kind != 1, F.array(F.lit(CHAT_TOOL))).otherwise(F.array().cast("array<string>"))
    recs = recs.select("conv_id", messages.alias("messages"), functions.alias("functions"))
    recs = recs.withColumn("tools", choose_tools(F.col("messages"), F.col("functions")))
    text = render_chat(F.col("messages"), F.col("tools"), add_generation_prompt=True, enable_thinking=False)
    return recs.select("conv_id", F.octet_length(text).cast("bigint").alias("n_bytes"), F.md5(text).alias("render_md5"))


@register
def train_log_roundtrip(spark: SparkSession, base: str) -> DataFrame:
    """Log records with an auxiliary loss and saved states are
    appended as versions below the shared folder; the records and the latest
    state of each run are read back."""
    from .session import shared_path
    home = shared_path(spark, "train-log")
    logged = LG.logged_steps(_steps(spark, base), LOG_INTERVAL, LOG_LR)
    aux = F.col("step") / F.lit(1000.0)
    records = logged.select("run", "step", SC.total_loss(F.col("loss"), aux, PLAN_ACCUMULATION).alias("loss"),
                            aux.alias("aux_loss"))
    for part in (0, 1):  # a later append adds to the log
        LG.append_log(records.where(F.col("step") % 20 == part * LOG_INTERVAL), f"{home}/log")
    LG.append_log(records.where(F.col("step") % LOG_INTERVAL != 0), f"{home}/log")
    LG.append_log(records.select("run", F.lit(0).alias("epoch"), "step", F.lit(2).alias("world_size")), f"{home}/state")
    back = spark.read.parquet(f"{home}/log").groupBy("run").agg(
        F.count(F.lit(1)).alias("n_records"), F.round(F.sum("loss"), 4).alias("loss_sum"),
        F.round(F.sum(F.col("loss") - F.col("aux_loss")), 4).alias("task_sum"))
    state = LG.latest_progress(spark.read.parquet(f"{home}/state"))
    return join_on(back, state.select("run", F.col("step").alias("last_step"), "world_size"), ["run"])
