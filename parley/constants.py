"""These decide results and must stay exactly as they are."""

from __future__ import annotations

# --- fixed values: chat roles -------------------------------------------------
USER = "user"
ASSISTANT = "assistant"
SYSTEM = "system"

# Speaker name -> chat role, looked up lower-cased first, then as written.
ROLE_ALIASES = {
    "human": "user",
    "user": "user",
    "player": "user",
    "玩家": "user",
    "主角": "user",
    "gpt": "assistant",
    "assistant": "assistant",
    "npc": "assistant",
    "系统": "assistant",
    "旁白": "assistant",
    "narrator": "assistant",
    "bot": "assistant",
    "system": "system",
    "welcome": "system",
    "欢迎词": "system",
}

# Speaker name contains any of these words -> chat role; the first group that matches wins.
ROLE_KEYWORDS = (
    ("system", ("欢迎", "开场", "设定")),
    ("assistant", ("系统", "旁白", "叙述")),
    ("user", ("主角", "玩家", "用户")),
)

# --- fixed values: text -------------------------------------------------------
# What Python's str.strip() and str.split() treat as whitespace.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Removed by text normalisation: zero-width space, byte order mark.
ZERO_WIDTH = "\u200b\ufeff"

# --- fixed values: splits, sizes and report formats ---------------------------
TRAIN, VALIDATION, TEST = "train", "validation", "test"
TEST_FRACTION = 0.02
VALIDATION_FRACTION = 0.02
SEED = 42
HISTOGRAM_BINS = 50
PREVIEW_ROWS, PREVIEW_COLUMNS = 3, 8
MAX_LENGTH = 2048
MAX_NEW_TOKENS = 256
MIN_LATENCY_SEC = 1e-6
MAX_LOSS = 100.0
COMPARE_TITLE = "# Compare Before/After"
CHAT_SYSTEM_PROMPT = "你是一个游戏 NPC，请用自然、简短的方式与玩家对话。"
