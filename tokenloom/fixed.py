"""Fixed values that must equal the modelled training setup.

Everything here is a constant of the tokenizer configuration or the chat
template that the encoders reproduce; nothing is derived at run time.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the tokenizer configuration and chat template)
# ---------------------------------------------------------------------------
ENDOFTEXT = "<|endoftext|>"   # id 0, also pad and unk
IM_START = "<|im_start|>"     # id 1, bos
IM_END = "<|im_end|>"         # id 2, eos
SPECIAL_TOKENS = {ENDOFTEXT: 0, IM_START: 1, IM_END: 2}
PAD_ID = 0
BOS_ID = 1
EOS_ID = 2
IGNORE_INDEX = -100
MODEL_MAX_LENGTH = 32768

DEFAULT_SYSTEM = "You are a helpful assistant"
TOOLS_PREAMBLE = (
    "# Tools\n\nYou may call one or more functions to assist with the user query.\n\n"
    "You are provided with function signatures within <tools></tools> XML tags:\n<tools>"
)
TOOLS_POSTAMBLE = (
    "\n</tools>\n\nFor each function call, return a json object with function name and "
    "arguments within <tool_call></tool_call> XML tags:\n<tool_call>\n"
    "{\"name\": <function-name>, \"arguments\": <args-json-object>}\n</tool_call><|im_end|>\n"
)
TOOL_CALL_OPEN = "<tool_call>\n{\"name\": \""
TOOL_CALL_ARGS = "\", \"arguments\": "
TOOL_CALL_CLOSE = "}\n</tool_call>"
TOOL_RESPONSE_OPEN = "\n<tool_response>\n"
TOOL_RESPONSE_CLOSE = "\n</tool_response>"
GENERATION_PROMPT = "<|im_start|>assistant\n"
EMPTY_THINK = "<think>\n\n</think>\n\n"

# Marker strings whose token ids delimit supervised spans.
ASSISTANT_START_TEXT = IM_START + "assistant\n"
ASSISTANT_END_TEXT = IM_END + "\n"

# Default lengths used by the three training stages.
PRETRAIN_MAX_LENGTH = 512
SFT_MAX_LENGTH = 340
DPO_MAX_LENGTH = 1024
DPO_BETA = 0.1
BASE_SEED = 42

# ---------------------------------------------------------------------------
# Byte tokenizer (ours; the shipped vocabulary file is absent): specials keep
# their ids, every UTF-8 byte b becomes b + BYTE_OFFSET.
# ---------------------------------------------------------------------------
BYTE_OFFSET = 3
VOCAB_SIZE = 256 + BYTE_OFFSET
# Longest special string; one token never covers more characters than this.
MAX_CHARS_PER_TOKEN = max(len(s) for s in SPECIAL_TOKENS)


def byte_token_ids(text: str) -> list[int]:
    """Driver-side ids of a short constant text (markers only)."""
    out: list[int] = []
    i = 0
    while i < len(text):
        for special, sid in SPECIAL_TOKENS.items():
            if text.startswith(special, i):
                out.append(sid)
                i += len(special)
                break
        else:
            out.extend(b + BYTE_OFFSET for b in text[i].encode("utf-8"))
            i += 1
    return out


ASSISTANT_START_IDS = byte_token_ids(ASSISTANT_START_TEXT)
ASSISTANT_END_IDS = byte_token_ids(ASSISTANT_END_TEXT)
