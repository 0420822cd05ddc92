"""DuckDB statements that recompute each registered query independently.

They build token ids *structurally* (per turn: header unsupervised,
assistant body and end marker supervised), so they do not repeat the
marker search the Spark side performs. Fixture facts relied on: no text
contains ``<|`` and there are no tool messages (FIXTURES.md).
"""

from __future__ import annotations

from tokenloom import fixed as FX

L_PRETRAIN = 512
L_SFT = 512
L_DPO = 512
HISTORY = 2
PLAN_EPOCHS = 2
PLAN_BATCH = 16
SHARD_WORLD = 3
SHARD_BATCH = 8
LOG_INTERVAL = 10
BATCH_TOKENS = 16_384


def byte_ids(expr: str) -> str:
    """DuckDB list of byte ids (UTF-8 byte + 3) of a VARCHAR expression."""
    return (f"list_transform(regexp_extract_all(hex({expr}), '..'), "
            f"lambda x: ('0x' || x)::INTEGER + 3)")


def pad(expr: str, length: int, value: int) -> str:
    return (f"list_concat({expr}, list_transform(range(greatest({length} - len({expr}), 0)), "
            f"lambda x: {value}))")


def md5_list(expr: str) -> str:
    return f"md5(array_to_string({expr}, ','))"


def pretrain_encode() -> str:
    L = L_PRETRAIN
    # whole text tokenized, then truncated (no character prefix)
    core = f"list_concat([1], list_slice({byte_ids(f'coalesce(text, {chr(39)}None{chr(39)})')}, 1, {L - 2}), [2])"
    return f"""
with c as (select doc_id as sample_id, {core} as core from documents)
select sample_id,
       {md5_list(pad('core', L, 0))} as ids_md5,
       {md5_list(pad('core', L, -100))} as labels_md5,
       cast(len(core) as bigint) as n_label_tokens
from c"""


def lit(s: str) -> str:
    """Python text -> DuckDB expression (newlines as chr(10))."""
    parts = [("'" + p.replace("'", "''") + "'") for p in s.split("\n")]
    return " || chr(10) || ".join(parts)


IM_S, IM_E, NL = "'<|im_start|>'", "'<|im_end|>'", "chr(10)"
DEFAULT_HEAD = lit("<|im_start|>system\nYou are a helpful assistant<|im_end|>\n")


def rendered_turn(role: str = "role", text: str = "text", first: str = "turn = 0") -> str:
    """Rendered text of one turn (no tools in the fixture)."""
    return (f"case when {role} = 'system' and {first} then {IM_S} || 'system' || {NL} || {text} || {IM_E} || {NL} "
            f"when {role} = 'user' or {role} = 'system' then {IM_S} || {role} || {NL} || {text} || {IM_E} || {NL} "
            f"when {role} = 'assistant' then {IM_S} || 'assistant' || {NL} || {text} || {IM_E} || {NL} "
            f"else '' end")


def chat_render() -> str:
    return f"""
with c as (
  select conv_id, count(*) as n, bool_or(turn = 0 and role = 'system') as sys_first,
         string_agg({rendered_turn()}, '' order by turn) as body
  from conversations group by conv_id),
r as (select conv_id, n, case when sys_first then '' else {DEFAULT_HEAD} end || body as s from c)
select conv_id, cast(n as bigint) as n_messages, cast(strlen(s) as bigint) as n_bytes, md5(s) as render_md5
from r"""


M100 = "-100"


def turn_tokens(role: str = "role", text: str = "text", first: str = "turn = 0") -> tuple[str, str]:
    """(ids, labels) lists of one turn, built from its structure."""
    head = f"case when {role} = 'system' and {first} then 'system' else {role} end || chr(10)"
    ids = (f"case when {role} in ('user', 'system', 'assistant') then "
           f"list_concat([1], {byte_ids(head + ' || ' + text)}, [2, 13]) else [] end")
    sup = (f"list_concat(list_transform(range(11), lambda x: {M100}), {byte_ids(text)}, [2, 13])")
    labels = (f"case when {role} = 'assistant' then {sup} "
              f"when {role} in ('user', 'system') then list_transform({ids}, lambda x: {M100}) "
              f"else [] end")
    return ids, labels


DEFAULT_HEAD_IDS = "list_concat([1], " + byte_ids(lit("system\nYou are a helpful assistant")) + ", [2, 13])"


def sft_encode() -> str:
    L = L_SFT
    ids, labels = turn_tokens()
    return f"""
with t as (select conv_id, turn, role, {ids} as ids, {labels} as labels from conversations),
c as (
  select conv_id, bool_or(turn = 0 and role = 'system') as sys_first,
         flatten(list(ids order by turn)) as ids, flatten(list(labels order by turn)) as labels
  from t group by conv_id),
h as (
  select conv_id,
         list_slice(case when sys_first then ids else list_concat({DEFAULT_HEAD_IDS}, ids) end, 1, {L}) as ids,
         list_slice(case when sys_first then labels
                    else list_concat(list_transform({DEFAULT_HEAD_IDS}, lambda x: {M100}), labels) end, 1, {L}) as labels
  from c)
select conv_id, {md5_list(pad('ids', L, 0))} as ids_md5, {md5_list(pad('labels', L, -100))} as labels_md5,
       cast(len(ids) as bigint) as n_tokens,
       cast(len(list_filter(labels, lambda x: x <> {M100})) as bigint) as n_supervised
from h"""


def _encoded(src: str, key: str, L: int, text: str = "text") -> str:
    """CTE body: (key, ids, labels) cut to L (unpadded) from a turns relation."""
    ids, labels = turn_tokens(text=text)
    return f"""
  select {key}, list_slice(case when sys_first then ids else list_concat({DEFAULT_HEAD_IDS}, ids) end, 1, {L}) as ids,
         list_slice(case when sys_first then labels
                    else list_concat(list_transform({DEFAULT_HEAD_IDS}, lambda x: {M100}), labels) end, 1, {L}) as labels
  from (select {key}, bool_or(turn = 0 and role = 'system') as sys_first,
               flatten(list(ids order by turn)) as ids, flatten(list(labels order by turn)) as labels
        from (select {key}, turn, role, {ids} as ids, {labels} as labels from {src}) group by {key})"""


def sft_supervised_tokens() -> str:
    return f"""
with h as ({_encoded('conversations', 'conv_id', L_SFT)}),
u as (select conv_id, unnest(range(len(labels))) as pos, unnest(labels) as token from h)
select conv_id, cast(pos as bigint) as pos, cast(token as bigint) as token from u where token <> {M100}"""


PAIRS_CTE = """
a as (select conv_id, max(turn) filter (where role = 'assistant') as cut
      from conversations group by conv_id having max(turn) filter (where role = 'assistant') is not null),
r as (select conv_id, cut, row_number() over (order by conv_id) - 1 as pos, count(*) over () as n from a),
lt as (select r.*, c.text as last_text from r join conversations c on c.conv_id = r.conv_id and c.turn = r.cut),
nx as (select x.conv_id, x.cut, y.last_text as next_text from lt x join lt y on y.pos = (x.pos + 1) % x.n),
msgs as (select c.conv_id, c.turn, c.role, c.text,
                case when c.turn = nx.cut then nx.next_text else c.text end as rtext
         from conversations c join nx on c.conv_id = nx.conv_id where c.turn <= nx.cut)"""


def dpo_pairs() -> str:
    return f"""
with {PAIRS_CTE},
g as (select conv_id, count(*) as n, bool_or(turn = 0 and role = 'system') as sys_first,
             string_agg({rendered_turn()}, '' order by turn) as cb,
             string_agg({rendered_turn(text='rtext')}, '' order by turn) as rb
      from msgs group by conv_id)
select conv_id as pair_id, cast(n as bigint) as n_messages,
       md5(case when sys_first then '' else {DEFAULT_HEAD} end || cb) as chosen_md5,
       md5(case when sys_first then '' else {DEFAULT_HEAD} end || rb) as rejected_md5
from g"""


def dpo_encode() -> str:
    L = L_DPO
    def side(name: str) -> str:
        ids = pad(f"{name}.ids", L, 0)
        mask = pad(f"list_transform({name}.labels, lambda x: case when x = {M100} then 0 else 1 end)", L, 0)
        return (f"{md5_list(f'list_slice({ids}, 1, {L - 1})')} as x_{name}_md5, "
                f"{md5_list(f'list_slice({ids}, 2, {L})')} as y_{name}_md5, "
                f"{md5_list(f'list_slice({mask}, 2, {L})')} as mask_{name}_md5, "
                f"cast(list_sum(list_slice({mask}, 2, {L})) as bigint) as n_mask_{name}")
    return f"""
with {PAIRS_CTE},
chosen as ({_encoded('msgs', 'conv_id', L)}),
rejected as ({_encoded('msgs', 'conv_id', L, text='rtext')})
select chosen.conv_id as pair_id, {side('chosen')}, {side('rejected')}
from chosen join rejected on chosen.conv_id = rejected.conv_id"""


PLAN_LR = 5e-4
PLAN_ACCUMULATION = 4
SAVE_INTERVAL = 20
RESUME_SKIP = 7 * 2 // 3


def _perm(epochs: int) -> str:
    return f"""
  select epoch, sample_id,
         row_number() over (partition by epoch order by
           md5(cast(42 + epoch as varchar) || ':' || cast(sample_id as varchar)), sample_id) - 1 as pos
  from (select d.doc_id as sample_id, cast(x.epoch as integer) as epoch
        from documents d cross join (select unnest(range({epochs})) as epoch) x)"""


def epoch_plan() -> str:
    return f"""
with p as ({_perm(PLAN_EPOCHS)})
select epoch, sample_id, cast(pos as bigint) as pos, cast(pos // {PLAN_BATCH} + 1 as bigint) as step,
       cast(pos % {PLAN_BATCH} as integer) as slot from p"""


def natural_order_plan() -> str:
    return f"""
with p as (select cast(0 as integer) as epoch, doc_id as sample_id, row_number() over (order by doc_id) - 1 as pos
           from documents)
select epoch, sample_id, cast(pos as bigint) as pos, cast(pos // {PLAN_BATCH} + 1 as bigint) as step,
       cast(pos % {PLAN_BATCH} as integer) as slot from p"""


def _sharded(epochs: int) -> str:
    W, B = SHARD_WORLD, SHARD_BATCH
    return f"""
  select p.epoch, cast(q.qpos % {W} as integer) as rank, cast((q.qpos // {W}) // {B} + 1 as bigint) as step,
         cast((q.qpos // {W}) % {B} as integer) as slot, cast(q.qpos as bigint) as pos, p.sample_id
  from (select unnest(range(cast(ceil(n / {W}.0) * {W} as bigint))) as qpos, n
        from (select count(*) as n from documents)) q
  join ({_perm(epochs)}) p on p.pos = q.qpos % q.n"""


def rank_shards() -> str:
    return f"select * from ({_sharded(1)})"


def resume_plan() -> str:
    return f"""
select epoch, rank, step, slot, sample_id from ({_sharded(PLAN_EPOCHS)})
where epoch > 0 or step > {RESUME_SKIP}"""


def resume_batch_counts() -> str:
    W, B = SHARD_WORLD, SHARD_BATCH
    return f"""
with n as (select cast(ceil(count(*) / {W}.0) as bigint) as per_rank from documents),
g as (select cast(e.epoch as integer) as epoch, cast(r.rank as integer) as rank,
             case when e.epoch = 0 then {RESUME_SKIP} else 0 end as skip, n.per_rank
      from n cross join (select unnest(range({PLAN_EPOCHS})) as epoch) e
             cross join (select unnest(range({W})) as rank) r)
select epoch, rank,
       cast(greatest(0, cast(ceil(per_rank / {B}.0) as bigint) - skip) as bigint) as n_batches,
       cast(greatest(0, per_rank - skip * {B}) as bigint) as n_samples
from g"""


def batch_fetch() -> str:
    L = L_PRETRAIN
    ntok = f"least(len({byte_ids('text')}), {L - 2}) + 2"
    return f"""
with p as ({_perm(PLAN_EPOCHS)}),
s as (select doc_id as sample_id, {ntok} as n_label_tokens from documents)
select p.epoch, cast(p.pos // {PLAN_BATCH} + 1 as bigint) as step, cast(count(*) as bigint) as n_samples,
       cast(sum(s.n_label_tokens) as bigint) as n_tokens, cast(sum(p.sample_id) as bigint) as id_sum
from p join s on p.sample_id = s.sample_id
group by 1, 2"""


def _mixed(x: str, key: str) -> str:
    t = f"(({x}) * 2654435 + {key}) % 2147483647"
    t = f"(xor({t}, ({t}) >> 15) * 48271 + 11) % 2147483647"
    return f"xor({t}, ({t}) >> 13)"


def _feistel() -> str:
    """(epoch, pos, ordinal) of all positions: one half-round a step of the
    recursion, begun anew while the result lies beyond the samples."""
    key = _mixed("i + 1", f"((42 + epoch) * 69621 % 2147483647)")
    return f"""
size as (select n, a, cast(ceil(n / cast(a as double)) as bigint) as b
         from (select count(*) as n, cast(ceil(sqrt(count(*))) as bigint) as a from documents)),
walk as (
  select cast(e.epoch as integer) as epoch, p.pos, cast(0 as bigint) as i, p.pos // b as l, p.pos % b as r, n, a, b
  from size cross join (select unnest(range({PLAN_EPOCHS})) as epoch) e
       cross join (select unnest(range((select count(*) from documents))) as pos) p
  union all
  select epoch, pos, case when i = 6 then 0 else i + 1 end,
         case when i < 6 and i % 2 = 0 then (l + {_mixed('r', key)}) % a else l end,
         case when i < 6 and i % 2 = 1 then (r + {_mixed('l', key)}) % b else r end, n, a, b
  from walk where i < 6 or l * b + r >= n),
perm as (
  select w.epoch, w.pos, d.sample_id from walk w
  join (select doc_id as sample_id, row_number() over (order by doc_id) - 1 as ordinal from documents) d
    on d.ordinal = w.l * w.b + w.r
  where w.i = 6 and w.l * w.b + w.r < w.n)"""


_PLACE = (f"cast(pos % {SHARD_WORLD} as integer) as rank, "
          f"cast((pos // {SHARD_WORLD}) // {SHARD_BATCH} + 1 as bigint) as step, "
          f"cast((pos // {SHARD_WORLD}) % {SHARD_BATCH} as integer) as slot, cast(pos as bigint) as pos")


def rank_steps() -> str:
    return f"""
with recursive {_feistel()},
padded as (select p.epoch, q.pos, p.sample_id from perm p
           join (select unnest(range(cast(ceil(n / {SHARD_WORLD}.0) * {SHARD_WORLD} as bigint))) as pos, n from size) q
             on p.pos = q.pos % q.n)
select * from (select epoch, {_PLACE}, sample_id from padded) where rank = 1 and step between 5 and 9"""


def sample_positions() -> str:
    return f"with recursive {_feistel()} select sample_id, epoch, {_PLACE} from perm"


def batch_fetch_repeated() -> str:
    return f"""
with d as (select case when doc_id % 5 <> 0 then cast(doc_id // 3 as varchar) else 'none' end as sample, n_chars
           from documents)
select cast(e.epoch as integer) as epoch, sample, count(*) as n_slots, count(*) as n_positions,
       count(*) as n_samples, cast(sum(n_chars) as bigint) as n_chars
from d cross join (select unnest(range({PLAN_EPOCHS})) as epoch) e group by 1, 2"""


def step_calendar() -> str:
    W, B, A = SHARD_WORLD, SHARD_BATCH, PLAN_ACCUMULATION
    return f"""
with m as ({_sharded(PLAN_EPOCHS)}),
it as (select cast(ceil(ceil(count(*) / {W}.0) / {B}.0) as bigint) as iters from documents),
c as (select epoch, step, count(*) as n_samples from m group by 1, 2)
select epoch, step, cast(n_samples as bigint) as n_samples,
       round(({PLAN_LR} / 10 + 0.5 * {PLAN_LR} * (1 + cos(pi() * (epoch * iters + step) / ({PLAN_EPOCHS} * iters)))) * 1e6, 6) as lr_e6,
       (step % {LOG_INTERVAL} = 0 or step = iters - 1) as is_log,
       (step % {SAVE_INTERVAL} = 0 or step = iters - 1) as is_save,
       ((step + 1) % {A} = 0) as is_update,
       cast(epoch * (((iters + 1) // {A}) - (1 // {A})) + ((step + 1) // {A}) - (1 // {A}) as bigint) as update_id
from c cross join it"""


CE_BATCH = 4
BETA = 0.1

TOKENS_CTE = """
tk as (
  select vec_id // 10 as seq_id, cast(vec_id % 10 as integer) as pos, label,
         case when vec_id % 10 >= 3 and (vec_id // 10) % 7 <> 0 then 1 else 0 end as mask,
         (vec_id // 10) // 2 as pair_id, case when (vec_id // 10) % 2 = 0 then 'chosen' else 'rejected' end as side,
         list_transform(embedding, lambda x: cast(x as double)) as lg
  from embeddings),
mx as (select *, list_max(lg) as m1, list_max(list_transform(lg, lambda x: 0.5 * x)) as m2 from tk),
sc as (
  select seq_id, pos, label, mask, pair_id, side,
         lg[label + 1] - m1 - ln(list_sum(list_transform(lg, lambda x: exp(x - m1)))) as logp,
         0.5 * lg[label + 1] - m2 - ln(list_sum(list_transform(lg, lambda x: exp(0.5 * x - m2)))) as ref_logp
  from mx)"""


def token_logprob() -> str:
    return f"with {TOKENS_CTE} select seq_id, pos, round(logp, 6) as logp, round(ref_logp, 6) as ref_logp from sc"


def masked_cross_entropy() -> str:
    return f"""
with {TOKENS_CTE},
sh as (select seq_id, mx.*, lead(label) over (partition by seq_id order by pos) as nl,
              lead(mask) over (partition by seq_id order by pos) as nm from mx),
v as (select seq_id // {CE_BATCH} as batch_id, (nl is not null and nm = 1) as valid,
             lg[nl + 1] - m1 - ln(list_sum(list_transform(lg, lambda x: exp(x - m1)))) as logp from sh)
select cast(batch_id as bigint) as batch_id, cast(sum(case when valid then 1 else 0 end) as bigint) as n_tokens,
       round(avg(case when valid then -logp end), 6) as loss
from v group by 1"""


def sequence_logprob() -> str:
    return f"""
with {TOKENS_CTE}
select seq_id, cast(sum(mask) as bigint) as n_mask,
       round(sum(logp * mask) / greatest(sum(mask), 1e-8), 6) as policy_avg,
       round(sum(ref_logp * mask) / greatest(sum(mask), 1e-8), 6) as ref_avg
from sc group by seq_id"""


MARGIN_CTE = """
sq as (select seq_id, pair_id, side, sum(logp * mask) / greatest(sum(mask), 1e-8) as pol,
              sum(ref_logp * mask) / greatest(sum(mask), 1e-8) as ref from sc group by 1, 2, 3),
pr as (select c.pair_id, c.pol as pc, r.pol as prj, c.ref as rc, r.ref as rr,
              (c.pol - r.pol) - (c.ref - r.ref) as logit
       from sq c join sq r on c.pair_id = r.pair_id and c.side = 'chosen' and r.side = 'rejected'),
mg as (select pair_id, logit, {b} * (pc - rc) as cr, {b} * (prj - rr) as rjr,
              {b} * (pc - rc) - {b} * (prj - rr) as margin,
              greatest(-{b} * logit, 0) + ln(1 + exp(-abs({b} * logit))) as pair_loss from pr)"""


def reward_margin() -> str:
    return f"""
with {TOKENS_CTE}, {MARGIN_CTE.format(b=BETA)}
select pair_id, round(logit, 6) as logit, round(cr, 6) as chosen_reward, round(rjr, 6) as rejected_reward,
       round(margin, 6) as margin, round(pair_loss, 6) as pair_loss from mg"""


def dpo_loss() -> str:
    return f"""
with {TOKENS_CTE}, {MARGIN_CTE.format(b=BETA)}
select cast(count(*) as bigint) as n_pairs, round(avg(pair_loss), 6) as loss, round(avg(margin), 6) as mean_margin,
       cast(sum(case when margin > 0 then 1 else 0 end) as bigint) as n_positive,
       round(avg(case when margin > 0 then 1.0 else 0.0 end), 6) as accuracy
from mg"""


MAXLEN = 32768
LOG_LR = 5e-4


def _token_count(expr: str) -> str:
    """Tokens of a rendered text: bytes, with each special string as one."""
    def occ(pat: str) -> str:
        return f"((strlen({expr}) - strlen(replace({expr}, '{pat}', ''))) // {len(pat)})"
    return f"(strlen({expr}) - 11 * {occ('<|im_start|>')} - 9 * {occ('<|im_end|>')})"


def history_prompts() -> str:
    gen = lit("<|im_start|>assistant\n")
    return f"""
with p0 as (select *, row_number() over (partition by conv_id order by turn) - 1 as i from conversations),
u as (select conv_id, turn as ut, i as ui from p0 where role = 'user'),
w as (select u.conv_id, u.ut, c.turn, c.role, c.text, c.i = u.ui - least(u.ui, {HISTORY}) as is_first
      from u join p0 c on c.conv_id = u.conv_id and c.i between u.ui - {HISTORY} and u.ui),
g as (select conv_id, ut, count(*) as n, bool_or(is_first and role = 'system') as sys_first,
             string_agg({rendered_turn(first='is_first')}, '' order by turn) as body
      from w group by 1, 2),
p as (select conv_id, ut, n, (case when sys_first then '' else {DEFAULT_HEAD} end) || body || {gen} as s from g)
select conv_id, ut as turn, cast(n as bigint) as n_messages,
       cast(least({_token_count('s')}, {MAXLEN}) as bigint) as n_tokens, md5(s) as prompt_md5
from p"""


def reply_rounds() -> str:
    gen = lit("<|im_start|>assistant\n")
    return f"""
with rows as (select conv_id, turn as was, 0 as k, role, text from conversations
              union all
              select conv_id, turn, x.k, 'assistant', text
              from conversations cross join (select unnest([1, 2]) as k) x where role = 'user'),
p0 as (select *, row_number() over (partition by conv_id order by was, k) - 1 as turn from rows),
u as (select conv_id, turn as ut from p0 where role = 'user'),
w as (select u.conv_id, u.ut, c.turn, c.role, c.text, c.turn = u.ut - least(u.ut, {HISTORY}) as is_first
      from u join p0 c on c.conv_id = u.conv_id and c.turn between u.ut - {HISTORY} and u.ut),
g as (select conv_id, ut, count(*) as n, bool_or(is_first and role = 'system') as sys_first,
             string_agg({rendered_turn(first='is_first')}, '' order by turn) as body
      from w group by 1, 2),
p as (select conv_id, ut, n, (case when sys_first then '' else {DEFAULT_HEAD} end) || body || {gen} as s from g)
select p0.conv_id, cast(p0.turn as bigint) as turn, p0.role, md5(p0.text) as content_md5,
       cast(coalesce(p.n, 0) as bigint) as n_messages, coalesce(md5(p.s), '') as prompt_md5
from p0 left join p on p.conv_id = p0.conv_id and p.ut = p0.turn"""


def length_state() -> str:
    return f"""
with t as (select lang, {_token_count('text')} as n from documents)
select lang, count(*) as n_docs, cast(sum(n) as bigint) as total_tokens, round(avg(n), 6) as avg_tokens,
       cast(max(n) as bigint) as max_tokens, cast(sum(case when n > {L_PRETRAIN - 2} then 1 else 0 end) as bigint) as n_truncated,
       round(sum({L_PRETRAIN} - least(n, {L_PRETRAIN - 2}) - 2) / (count(*) * {L_PRETRAIN}.0), 6) as pad_share,
       cast(quantile_disc(n, 0.5) as bigint) as q50_tokens, cast(quantile_disc(n, 0.9) as bigint) as q90_tokens,
       cast(quantile_disc(n, 0.99) as bigint) as q99_tokens
from t group by 1"""


def stream_rejects() -> str:
    return f"""
with good as (select * from ({pretrain_encode()}) where sample_id % 50 <> 7),
bad as (select doc_id, '{{"sample_id": ' || doc_id as line from documents where doc_id % 50 = 7)
select 'sample' as kind, cast(sample_id as varchar) as name, ids_md5 as md5 from good
union all select 'reject', cast(doc_id as varchar), md5(line) from bad
union all select 'progress', (select count(*) from good) || '/' || (select count(*) from bad), ''"""


def generation_batches() -> str:
    return f"""
with d as (select doc_id, least(strlen(text) + 1, {MAXLEN}) as n from documents),
w as (select *, greatest(1, 1 << greatest(0, cast(floor(log2(n)) as integer) - 3)) as step from d),
c as (select *, cast(ceil(n / cast(step as double)) as bigint) * step as batch_width from w),
r as (select *, (row_number() over (partition by batch_width order by n, doc_id) - 1)
                // greatest(1, {BATCH_TOKENS} // batch_width) as batch_no from c),
b as (select batch_width, batch_no, count(*) as rows, sum(n) as tokens, max(n) * count(*) as padded from r group by 1, 2)
select cast(batch_width as bigint) as batch_width, count(*) as n_batches, cast(sum(rows) as bigint) as n_prompts,
       cast(sum(tokens) as bigint) as n_tokens, cast(sum(padded) as bigint) as n_padded,
       cast(max(padded) as bigint) as largest, round(1 - sum(tokens) / sum(padded), 6) as pad_share
from b group by 1"""


def generation_resumed() -> str:
    return """
select doc_id, cast(2 * (strlen(substr(text, 1, 200)) + 1) as bigint) as n_ids, md5(substr(text, 1, 200)) as reply_md5
from documents"""


def vocab_reply() -> str:
    return "select doc_id, md5(text) as reply_md5, cast(strlen(text) as bigint) as n_bytes from documents"


def pretrain_prompts() -> str:
    ids = f"list_slice(list_concat([1], {byte_ids('text')}), 1, {MAXLEN})"
    return f"""
select item_id, cast(len({ids}) as bigint) as n_tokens, {md5_list(ids)} as ids_md5 from benchmark"""


def bulk_reply() -> str:
    return """
select conv_id, 2 * turn as turn, role, md5(text) as reply_md5, cast(strlen(text) as bigint) as n_bytes
from conversations
union all
select conv_id, 2 * turn + 1, 'assistant', md5(text), cast(strlen(text) as bigint)
from conversations where role = 'user'"""


STEPS_CTE = """
st as (select user_id as run, ts, event_id, value as loss,
              row_number() over (partition by user_id order by ts, event_id) as step,
              count(*) over (partition by user_id) as iters,
              min(ts) over (partition by user_id) as run_start
       from events)"""


def train_log_sample() -> str:
    return f"""
with {STEPS_CTE}
select run, cast(step as bigint) as step, cast(iters as bigint) as iters, round(loss, 6) as loss,
       round(loss, 6) as logits_loss,
       round(({LOG_LR} / 10 + 0.5 * {LOG_LR} * (1 + cos(pi() * (0 * iters + step) / (1 * iters)))) * 1e6, 6) as lr_e6
from st where step % {LOG_INTERVAL} = 0 or step = iters - 1"""


def train_eta() -> str:
    spent = "((epoch_us(ts) - epoch_us(run_start)) / 1e6)"
    return f"""
with {STEPS_CTE}
select run, cast(step as bigint) as step, round({spent}, 6) as spent_sec,
       cast(floor({spent} / (step + 1) * iters / 60) - floor({spent} / 60) as bigint) as eta_min
from st where step % {LOG_INTERVAL} = 0 or step = iters - 1"""


def latest_progress() -> str:
    return f"""
with {STEPS_CTE}
select run, cast(0 as integer) as epoch, cast(step as bigint) as step, cast(1 + run % 4 as integer) as world_size,
       cast(step * (1 + run % 4) // 2 as bigint) as resume_step
from st where step = iters"""


def _length_report(src: str, keys: str) -> str:
    L = L_PRETRAIN
    return f"""
with t as (select {keys}, strlen(coalesce(text, 'None')) as n from {src}),
r as (select {keys}, n, row_number() over (partition by {keys} order by n) as rk,
             count(*) over (partition by {keys}) as cnt from t)
select {keys}, cast(count(*) as bigint) as n_docs, cast(sum(n) as bigint) as total_tokens,
       round(avg(n), 6) as avg_tokens, cast(max(n) as bigint) as max_tokens,
       cast(min(case when rk >= ceil(0.5 * cnt) then n end) as bigint) as median_tokens,
       cast(sum(case when n > {L - 2} then 1 else 0 end) as bigint) as n_truncated,
       round(sum({L} - (least(n, {L - 2}) + 2)) / (count(*) * {L}), 6) as pad_share
from r group by {keys}"""


def length_report() -> str:
    return _length_report("documents", "lang")


def length_report_by_quality() -> str:
    return _length_report("(select d.text, l.quality, l.toxic from documents d join labels l on d.doc_id = l.doc_id)",
                          "quality, toxic")


def sft_length_report() -> str:
    L = L_SFT
    return f"""
with h as ({_encoded('conversations', 'conv_id', 1000000)}),
s as (select conv_id, len(ids) as n_tokens,
             len(list_filter(list_slice(labels, 1, {L}), lambda x: x <> {M100})) as n_sup from h)
select cast(count(*) as bigint) as n_samples, cast(sum(n_tokens) as bigint) as total_tokens,
       cast(max(n_tokens) as bigint) as max_tokens,
       cast(sum(case when n_tokens > {L} then 1 else 0 end) as bigint) as n_truncated,
       cast(sum(case when n_sup = 0 then 1 else 0 end) as bigint) as n_no_supervised,
       round(sum(n_sup) / sum(least(n_tokens, {L})), 6) as supervised_share
from s"""


def training_shards() -> str:
    L = L_PRETRAIN
    ntok = f"least(len({byte_ids('text')}), {L - 2}) + 2"
    return f"""
with m as ({_sharded(1)}),
s as (select doc_id as sample_id, {ntok} as n_label_tokens from documents)
select m.epoch, m.rank, cast(count(*) as bigint) as n_samples, cast(count(distinct m.step) as bigint) as n_steps,
       cast(sum(m.sample_id) as bigint) as id_sum, cast(sum(s.n_label_tokens) as bigint) as n_tokens
from m join s on m.sample_id = s.sample_id group by 1, 2"""


DPO_BATCH = 4


def dpo_batch_loss() -> str:
    return f"""
with {TOKENS_CTE}, {MARGIN_CTE.format(b=BETA)}
select cast(pair_id // {DPO_BATCH} as bigint) as batch_id, cast(count(*) as bigint) as n_pairs,
       round(avg(pair_loss), 6) as loss, round(avg(margin), 6) as mean_margin,
       cast(sum(case when margin > 0 then 1 else 0 end) as bigint) as n_positive
from mg group by 1"""


def update_batches() -> str:
    A = PLAN_ACCUMULATION
    return f"""
with m as ({_sharded(PLAN_EPOCHS)}),
s as (select epoch, step, count(*) as n, (step + 1) % {A} = 0 as flag from m group by 1, 2),
u as (select *, 1 + coalesce(sum(cast(flag as int)) over (order by epoch, step
      rows between unbounded preceding and 1 preceding), 0) as update_id from s)
select cast(update_id as bigint) as update_id, cast(sum(n) as bigint) as n_samples, count(*) as n_micro_steps,
       bool_or(flag) as complete
from u group by 1"""


def stack_sides() -> str:
    L = L_DPO
    def side(name: str) -> str:
        ids = f"list_slice({pad('ids', L, 0)}, 2, {L})"
        mask = f"list_slice({pad(f'list_transform(labels, lambda x: case when x = {M100} then 0 else 1 end)', L, 0)}, 2, {L})"
        return f"select conv_id, '{name}' as side, {ids} as y, {mask} as mask from {name}"
    return f"""
with {PAIRS_CTE},
chosen as ({_encoded('msgs', 'conv_id', L)}),
rejected as ({_encoded('msgs', 'conv_id', L, text='rtext')}),
s as ({side('chosen')} union all {side('rejected')})
select conv_id as pair_id, side, cast(len(y) as bigint) as n_rows, cast(list_sum(mask) as bigint) as n_mask,
       cast(list_sum(list_transform(range(1, len(y) + 1), lambda i: i * mask[i] * y[i])) as bigint) as weighted
from s"""


def _counted(sql: str, cols: str) -> str:
    return f"select {cols}, count(*) as n_rows from ({sql}) group by all"


def chat_tools() -> str:
    calls = "".join([f" || {lit(FX.TOOL_CALL_OPEN)} || 'lookup' || {lit(FX.TOOL_CALL_ARGS)} || '{{\"turn\": ' || turn || '}}' || "
                     f"{lit(FX.TOOL_CALL_CLOSE)}" + (f" || {lit(chr(10))}" if i == 0 else "") for i in (0, 1)])
    plain = f"{lit('<|im_start|>')} || role || {lit(chr(10))} || body || {lit('<|im_end|>' + chr(10))}"
    return f"""
with a as (select conv_id, turn, case when (conv_id + turn) % 11 = 0 then 'observer'
      when role = 'user' and (conv_id + turn) % 5 < 2 then 'tool'
      when role = 'assistant' and (conv_id + turn) % 13 = 0 then 'tool' else role end as role,
      case when (conv_id + turn) % 7 <> 0 then coalesce(text, '') else '' end as body from conversations),
n as (select *, row_number() over w = 1 as is_first, coalesce(lag(role) over w = 'tool', false) as prev_tool,
      coalesce(lead(role) over w = 'tool', false) as next_tool from a window w as (partition by conv_id order by turn)),
r as (select conv_id, turn, is_first and conv_id % 3 = 2 as leads, role, body, case
      when role = 'user' or (role = 'system' and not (is_first and conv_id % 3 = 2)) then {plain}
      when role = 'assistant' then {lit('<|im_start|>assistant' + chr(10))} || body || case when turn % 4 = 1
           then case when body <> '' then {lit(chr(10))} else '' end{calls} else '' end || {lit('<|im_end|>' + chr(10))}
      when role = 'tool' then case when prev_tool then '' else {lit('<|im_start|>user')} end || {lit(FX.TOOL_RESPONSE_OPEN)}
           || body || {lit(FX.TOOL_RESPONSE_CLOSE)} || case when next_tool then '' else {lit('<|im_end|>' + chr(10))} end
      else '' end as block from n),
h as (select conv_id, string_agg(block, '' order by turn) as blocks,
      max(case when leads and role = 'system' then body end) as own_system from r group by 1),
t as (select conv_id, case
      when conv_id % 3 = 0 then {lit('<|im_start|>system' + chr(10))} || 'Be brief.' || {lit(chr(10) * 2)}
           || {lit(FX.TOOLS_PREAMBLE)} || {lit(chr(10))} || '{{"name": "lookup"}}' || {lit(FX.TOOLS_POSTAMBLE)}
      when conv_id % 3 = 1 then {lit('<|im_start|>system' + chr(10))} || 'Be brief.' || {lit('<|im_end|>' + chr(10))}
      when own_system is not null then {lit('<|im_start|>system' + chr(10))} || own_system ||
           {lit(chr(10) * 2)} || {lit(FX.TOOLS_PREAMBLE)} || {lit(chr(10))} || '{{"name": "lookup"}}'
           || {lit(FX.TOOLS_POSTAMBLE)}
      else {DEFAULT_HEAD} end || blocks || {lit(FX.GENERATION_PROMPT + FX.EMPTY_THINK)} as s from h)
select conv_id, cast(strlen(s) as bigint) as n_bytes, md5(s) as render_md5 from t"""


def train_log_roundtrip() -> str:
    return f"""
with {STEPS_CTE},
l as (select run, step, loss + step / 1000.0 as loss, step / 1000.0 as aux from st
      where step % {LOG_INTERVAL} = 0 or step = iters - 1)
select run, count(*) as n_records, round(sum(loss), 4) as loss_sum, round(sum(loss - aux), 4) as task_sum,
       cast(max(step) as bigint) as last_step, cast(2 as integer) as world_size
from l group by run"""


def all_sql() -> dict[str, str]:
    dpo_cols = ", ".join(f"{p}_{s}_md5" for s in ("chosen", "rejected") for p in ("x", "y", "mask"))
    return {
        "score_align": sequence_logprob(),
        "stack_sides": stack_sides(),
        "jsonl_pretrain": _counted(pretrain_encode(), "ids_md5, labels_md5"),
        "jsonl_sft": _counted(sft_encode(), "ids_md5, labels_md5"),
        "jsonl_dpo": _counted(dpo_encode(), dpo_cols),
        "chat_tools": chat_tools(),
        "train_log_roundtrip": train_log_roundtrip(),
        "dpo_batch_loss": dpo_batch_loss(),
        "update_batches": update_batches(),
        "sft_length_report": sft_length_report(),
        "training_shards": training_shards(),
        "history_prompts": history_prompts(),
        "pretrain_prompts": pretrain_prompts(),
        "bulk_reply": bulk_reply(),
        "reply_rounds": reply_rounds(),
        "vocab_reply": vocab_reply(),
        "length_state": length_state(),
        "stream_rejects": stream_rejects(),
        "generation_batches": generation_batches(),
        "generation_resumed": generation_resumed(),
        "train_log_sample": train_log_sample(),
        "train_eta": train_eta(),
        "latest_progress": latest_progress(),
        "length_report": length_report(),
        "length_report_by_quality": length_report_by_quality(),
        "stream_encode": pretrain_encode(),
        "token_logprob": token_logprob(),
        "masked_cross_entropy": masked_cross_entropy(),
        "sequence_logprob": sequence_logprob(),
        "reward_margin": reward_margin(),
        "dpo_loss": dpo_loss(),
        "epoch_plan": epoch_plan(),
        "natural_order_plan": natural_order_plan(),
        "rank_shards": rank_shards(),
        "resume_plan": resume_plan(),
        "resume_batch_counts": resume_batch_counts(),
        "batch_fetch": batch_fetch(),
        "rank_steps": rank_steps(),
        "sample_positions": sample_positions(),
        "batch_fetch_repeated": batch_fetch_repeated(),
        "sliced_logprob": token_logprob(),
        "step_calendar": step_calendar(),
        "sft_supervised_tokens": sft_supervised_tokens(),
        "dpo_pairs": dpo_pairs(),
        "dpo_encode": dpo_encode(),
        "pretrain_encode": pretrain_encode(),
        "chat_render": chat_render(),
        "sft_encode": sft_encode(),
    }
