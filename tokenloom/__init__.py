"""tokenloom: Spark-native preparation and analysis of language-model training data.

Main entry points (all return DataFrames or Columns):

* sources: ``read_pretrain``, ``read_sft``, ``read_dpo``
* encoders: ``encode_pretrain``, ``encode_sft``, ``encode_dpo``
* chat: ``render_chat``, ``chat_records``, ``preference_pairs``
* plans: ``build_manifest``, ``resume``, ``resume_exact``, ``write_training_shards``
* scoring: ``with_token_logprob``, ``masked_cross_entropy``, ``pair_logratios``,
  ``reward_margins``, ``dpo_summary``
* prompts: ``history_messages``, ``generation_prompt``, ``generate``
* logs: ``number_steps``, ``logged_steps``, ``latest_progress``
"""

from .functions.chat import render_chat
from .operators.conversations import chat_records, preference_pairs
from .operators.encode import encode_dpo, encode_pretrain, encode_sft
from .operators.logs import latest_progress, logged_steps, number_steps
from .operators.prompts import generate, generation_prompt, history_messages
from .operators.scoring import (dpo_summary, masked_cross_entropy, pair_logratios,
                                reward_margins, with_token_logprob)
from .plans.epochs import build_manifest, resume, resume_exact, write_training_shards
from .sources.jsonl import read_dpo, read_pretrain, read_sft

__version__ = "0.1.0"

__all__ = [
    "render_chat", "chat_records", "preference_pairs", "encode_pretrain", "encode_sft",
    "encode_dpo", "number_steps", "logged_steps", "latest_progress", "history_messages",
    "generation_prompt", "generate", "with_token_logprob", "masked_cross_entropy",
    "pair_logratios", "reward_margins", "dpo_summary", "build_manifest", "resume",
    "resume_exact", "write_training_shards", "read_pretrain", "read_sft", "read_dpo",
]
