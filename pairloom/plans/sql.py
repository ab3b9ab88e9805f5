"""SQL pieces of the check queries (DuckDB dialect): the derived tables as CTEs."""

from __future__ import annotations

from ..functions.chat import INSTRUCTION, SYSTEM_PROMPT
from ..functions.tokens import FIRST_BYTE, FIRST_ID, NEXT_BYTE, PAD_ID, START_ID, UNK_ID
from .inputs import EPOCH_BATCHES, ROLLOUT_BATCH, STATE_ROWS, VOCAB_SIZE

START, END = "<|im_start|>", "<|im_end|>"
WORDS = r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]"
PLAIN = f"({WORDS})"
LINES = rf"(\n|{WORDS})"
MARKED = rf"(<\|im_start\|>|<\|im_end\|>|\n|{WORDS})"


def text(value: str) -> str:
    """An SQL string literal with line breaks."""
    return "E'" + value.replace("\\", "\\\\").replace("'", "''").replace("\n", "\\n") + "'"


USER_HEAD = text(f"{INSTRUCTION}\n")


def user(prompt: str) -> str:
    return f"({USER_HEAD} || {prompt})"


def escaped(value: str) -> str:
    """Markers inside content, broken as in rendering."""
    for marker in (START, END):
        value = f"replace({value}, '{marker}', '{marker[0]} {marker[1:]}')"
    return value


def prompt_chat(prompt: str) -> str:
    prompt = escaped(prompt)
    head = text(f"{START}system\n{SYSTEM_PROMPT}{END}\n{START}user\n{INSTRUCTION}\n")
    return f"({head} || {prompt} || {text(f'{END}{chr(10)}{START}assistant{chr(10)}')})"


def chat(prompt: str, answer: str) -> str:
    return f"({prompt_chat(prompt)} || {escaped(answer)} || {text(f'{END}{chr(10)}')})"


def tokens(expr: str, pattern: str = PLAIN) -> str:
    return f"regexp_extract_all({expr}, '{pattern}', 1)"


#: Ids of a token: its own, or its bytes when the vocabulary lacks it.
IDS = f"""CASE WHEN id IS NOT NULL THEN [id] ELSE [('0x' || substr(hex(token), 2 * i + 1, 2))::BIGINT
    + CASE WHEN i = 0 THEN {FIRST_BYTE} ELSE {NEXT_BYTE} END FOR i IN range(octet_length(encode(token)))] END"""


def score(vector: str) -> str:
    return f"list_sum([a::DOUBLE * ((((i - 1) * 7) % 11) - 5) / 10.0::DOUBLE FOR a, i IN {vector}])"


def softplus(x: str) -> str:
    return f"CASE WHEN {x} > 0 THEN {x} + ln(1 + exp(-({x}))) ELSE ln(1 + exp({x})) END"


def stage_case(i: str, n: str, *, gaps: bool = False) -> str:
    """The scaled stage plan as CASE."""
    gap = f"WHEN {i} >= {n} * 7 // 10 AND {i} < {n} * 8 // 10 THEN 'gap_before_policy'" if gaps else ""
    return f"""CASE WHEN {i} < {n} * 4 // 10 THEN 'sft' WHEN {i} < {n} * 7 // 10 THEN 'reward'
        WHEN {i} >= {n} * 8 // 10 AND {i} < {n} * 9 // 10 THEN 'policy' {gap} ELSE 'unused' END"""


CTES: dict[str, str] = {
    "turns": """SELECT conv_id, turn, role, text, lead(role) OVER w AS nr, lead(text) OVER w AS nt
        FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""",
    "p": """SELECT row_number() OVER (ORDER BY conv_id, turn) - 1 AS idx, conv_id, turn, text AS prompt, nt AS chosen
        FROM turns WHERE role = 'user' AND nr = 'assistant'""",
    "pairs": """SELECT p.idx, p.conv_id, p.turn, p.prompt, p.chosen, q.chosen AS rejected,
            CASE WHEN p.conv_id % 10 = 9 THEN 'valid1' ELSE 'train' END AS split,
            row_number() OVER (PARTITION BY p.conv_id % 10 = 9 ORDER BY p.idx) - 1 AS split_pos
        FROM p CROSS JOIN (SELECT count(*) AS n FROM p) c JOIN p q ON q.idx = (p.idx + 1) % c.n""",
    "train": "SELECT *, count(*) OVER () AS n FROM pairs WHERE split = 'train'",
    "rollouts": f"""SELECT idx, idx // {ROLLOUT_BATCH} AS batch_id, idx % {ROLLOUT_BATCH} AS pos, prompt,
            chosen AS response, e.embedding AS feature
        FROM pairs LEFT JOIN embeddings e ON e.vec_id = idx * 3""",
    "states": f"""SELECT vec_id // {STATE_ROWS} AS seq_id, list(embedding ORDER BY vec_id) AS states,
            count(*) - (vec_id // {STATE_ROWS}) % 5 - 1 AS last_pos
        FROM embeddings GROUP BY 1""",
    "run_steps": f"""SELECT run, m, m // {EPOCH_BATCHES} AS epoch, m % {EPOCH_BATCHES} AS batch_id, loss
        FROM (SELECT event_type AS run, value AS loss,
                     row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS m FROM events)""",
    "eval_points": "SELECT run, m + 1 AS step, loss AS eval_loss FROM run_steps",
    "candidates": """SELECT conv_id AS prompt_id, turn AS cand_id, text AS response, ln(1 + length(text)) AS logit
        FROM conversations WHERE role = 'assistant'""",
    "scores": f"SELECT vec_id, {score('embedding')} AS score FROM embeddings",
    "scored_pairs": f"""SELECT idx, idx // {ROLLOUT_BATCH} AS batch_id, c.score AS chosen_score, r.score AS rejected_score
        FROM pairs LEFT JOIN scores c ON c.vec_id = idx * 2 LEFT JOIN scores r ON r.vec_id = idx * 2 + 1""",
    "doc_rank": "SELECT doc_id, lang, row_number() OVER (ORDER BY doc_id) - 1 AS idx, count(*) OVER () AS n FROM documents",
    "shuffled": """SELECT doc_id, epoch,
            row_number() OVER (PARTITION BY epoch ORDER BY md5(doc_id || '|42|' || epoch), doc_id) - 1 AS idx
        FROM documents CROSS JOIN (SELECT unnest(range(3))::INT AS epoch)""",
    "batches": """SELECT epoch, idx // 4 AS batch_id, count(*) AS n_rows FROM shuffled GROUP BY ALL""",
    "groups": """SELECT *, batch_id // 24 AS accum_group FROM batches
        QUALIFY (batch_id // 24 + 1) * 24 <= count(*) OVER (PARTITION BY epoch)""",
    "steps": """SELECT g.*, epoch * (b.n // 24) + accum_group + 1 AS global_step, b.n AS batches_per_epoch
        FROM groups g CROSS JOIN (SELECT count(*) AS n FROM batches WHERE epoch = 0) b""",
    "chat_tokens": f"""SELECT idx, unnest(t) AS token, generate_subscripts(t, 1) AS place
        FROM (SELECT idx, {tokens(chat('prompt', 'chosen'), MARKED)} AS t FROM pairs)""",
    "vocab": f"""SELECT token, row_number() OVER (ORDER BY count(*) DESC, token) + {FIRST_ID - 1} AS id
        FROM chat_tokens WHERE token NOT IN ('{START}', '{END}') GROUP BY token
        QUALIFY id < {VOCAB_SIZE + FIRST_ID}
        UNION ALL SELECT * FROM (VALUES ('{END}', {PAD_ID}), ('<unk>', {UNK_ID}), ('{START}', {START_ID}))""",
    "asked": f"""SELECT idx, unnest(t) AS token, generate_subscripts(t, 1) AS place FROM (SELECT idx, {tokens(
        f"CASE WHEN idx % 5 = 4 THEN replace({prompt_chat('prompt')}, {USER_HEAD}, '{INSTRUCTION} ') ELSE {prompt_chat('prompt')} END", MARKED)} AS t FROM pairs)""",
    "encoded": f"""SELECT idx, flatten(list({IDS} ORDER BY place)) AS input_ids
        FROM chat_tokens LEFT JOIN vocab USING (token) GROUP BY idx""",
    "padded": f"""SELECT idx, idx // {ROLLOUT_BATCH} AS batch_id, idx % {ROLLOUT_BATCH} AS pos, len(input_ids) AS n,
            max(len(input_ids)) OVER (PARTITION BY idx // {ROLLOUT_BATCH}) AS width, input_ids
        FROM encoded""",
    "filled": f"SELECT *, input_ids || [{PAD_ID} FOR i IN range(width - n)] AS ids FROM padded",
    "staged": rf"""SELECT * FROM (SELECT r.idx, {stage_case('r.idx', 'r.n', gaps=True)} AS stage,
            md5(trim(lower(regexp_replace(d.text, '[ \t\n\r]+', ' ', 'g')), ' ')) AS h
        FROM doc_rank r JOIN documents d USING (doc_id))""",
    "grams": f"""SELECT doc_id, place, coalesce(lag(tok) OVER (PARTITION BY doc_id ORDER BY place), '<s>') AS prev, tok
        FROM (SELECT doc_id, unnest(t) AS tok, generate_subscripts(t, 1) AS place
              FROM (SELECT doc_id, {tokens('text')} AS t FROM documents))""",
}


def build(body: str, *names: str, recursive: bool = False) -> str:
    """``body`` after the CTEs ``names``, which are given in order of use."""
    parts = ", ".join(f"{n} AS ({CTES[n]})" for n in names)
    return f"WITH {'RECURSIVE ' if recursive else ''}{parts} {body}"


PAIRS = ("turns", "p", "pairs")
