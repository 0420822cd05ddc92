import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tokenloom.session import build_session
    s = build_session(master="local[*]", shuffle_partitions=8, app="tokenloom-tests")
    yield s
    s.stop()


# --- plain-Python references used by several tests (written from the
# described semantics, independent of the Spark expressions) ---------------
SPECIALS = {"<|endoftext|>": 0, "<|im_start|>": 1, "<|im_end|>": 2}


def py_tokenize(text: str) -> list[int]:
    out, i = [], 0
    while i < len(text):
        for s, v in SPECIALS.items():
            if text.startswith(s, i):
                out.append(v)
                i += len(s)
                break
        else:
            out.extend(b + 3 for b in text[i].encode("utf-8"))
            i += 1
    return out


START = py_tokenize("<|im_start|>assistant\n")
END = py_tokenize("<|im_end|>\n")


def py_scan_labels(ids: list[int], max_length: int) -> list[int]:
    """Supervised spans by a regular expression over the ids as characters:
    what follows a start marker, up to and with the next end marker."""
    import re
    chars = "".join(map(chr, ids))
    start, end = ("".join(map(chr, x)) for x in (START, END))
    spans = re.compile(f"{re.escape(start)}(.*?(?:{re.escape(end)}|\\Z))", re.S)
    keep = {i for m in spans.finditer(chars) for i in range(*m.span(1)) if i < max_length}
    return [t if i in keep else -100 for i, t in enumerate(ids)]
