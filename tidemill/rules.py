"""Rule tables as data.

Cleaning tables have fixed values.  Domain vocabulary (phrases that keep a short comment, priority
keywords, label rules) comes from the user as a RuleSet, in code or from a JSON file.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from pathlib import Path

# Emoticons removed in one alternation, ignoring case, in the final stage.
EMOTICONS = (
    r":\)+", r":\(+", r":v+", r":V+", r"=+\)+", r"=+\(+", r":d+", r":p+", r"<3+", r"=+\]+", r"=+\[+", r":>+", r":<+",
    r":\(\(", r"=\(\(",
)

# Emoticons removed one after the other, with case, in the first stage.
FIRST_EMOTICONS = (r":[)]+", r"=[)]+", r":\(\(", r"=\(\(", r":>+", r":<+", r":v+", r":V+", r"=\)+", r"=\(+")

# Page furniture cut out in the final stage, in this order.
UI_PHRASES = (
    "đã chỉnh sửa", "[đã chỉnh sửa]", "(đã chỉnh sửa)",
    "see more", "xem thêm", "see translation", "xem bản dịch",
    "ẩn bớt", "xem ít hơn", "dịch", "translated", "more", "less",
    "see more reactions",
)

# Page furniture cut out in the first stage, in this order.
FIRST_UI_PHRASES = (
    "[Đã chỉnh sửa]", "(Đã chỉnh sửa)", "Đã chỉnh sửa", "See Translation", "Xem bản dịch", "See more", "Xem thêm",
    "Ẩn bớt", "Xem ít hơn", "Dịch", "Translated", "more", "less",
)

# Letters kept beside a-z, A-Z, 0-9 and white space when punctuation goes.
KEPT_LETTERS = "àáảãạăằắẳẵặâầấẩẫậèéẻẽẹêềếểễệìíỉĩịòóỏõọôồốổỗộơờớởỡợùúủũụưừứửữựỳýỷỹỵđ"

# Emoji ranges.
EMOJI = r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1FAFF}\x{2702}-\x{27B0}\x{24C2}-\x{1F251}]+"

# Platforms named in file names, first match wins.
PLATFORMS = ("facebook", "youtube", "reddit", "tiktok", "threads")

# Requests a minute, requests a day and tokens a minute of one key by model.
QUOTAS = (
    ("gemini-2.5-pro", 5, 100, 250000), ("gemini-2.5-flash", 10, 250, 250000),
    ("gemini-2.5-flash-lite-preview-06-17", 15, 1000, 250000), ("gemini-2.5-flash-preview-tts", 3, 15, 10000),
    ("gemini-2.5-pro-preview-tts", 5, 100, 250000), ("gemini-2.0-flash", 15, 200, 1000000),
    ("gemini-2.0-flash-preview-image-generation", 10, 100, 200000), ("gemini-2.0-flash-lite", 30, 200, 1000000),
)
DEFAULT_MODEL = "gemini-2.5-flash"

# What a CSV reader takes for missing.
NA_VALUES = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


@dataclass(frozen=True)
class RuleSet:
    """Domain vocabulary: literals that keep a short comment, literals that give priority, three class
    names, two ordered lists of label regexes (the first beats the second), the token and the strong
    words of the false-positive correction, and an ordered lexicon."""

    keep: tuple[str, ...] = ()
    priority: tuple[str, ...] = ()
    neutral: str = "NEUTRAL"
    first: str = "A"
    second: str = "B"
    first_patterns: tuple[str, ...] = ()
    second_patterns: tuple[str, ...] = ()
    doubtful: str = ""
    strong: tuple[str, ...] = ()
    lexicon: tuple[tuple[str, str], ...] = field(default=())

    @property
    def labels(self) -> tuple[str, str, str]:
        return self.neutral, self.first, self.second

    @classmethod
    def load(cls, path: str) -> RuleSet:
        """From a JSON object with these names; the lexicon is an object of slang to standard form."""
        raw = json.loads(Path(path).read_text(encoding="utf-8"))
        raw["lexicon"] = tuple(raw.get("lexicon", {}).items())
        return cls(**{k: tuple(v) if isinstance(v, list) else v for k, v in raw.items()})


#: A small neutral rule set for the driver's synthetic texts.
SAMPLE = RuleSet(
    keep=("///", "3/", "the", "is"), priority=("tion", "ing"), neutral="NEUTRAL", first="FIRST", second="SECOND",
    first_patterns=(r"\b(idiot|moron|stupid)\b", r"\b(trash|scum)\b"), second_patterns=(r"\b(worthless|pathetic)\b", r"\b(clown)\b"),
    doubtful="the", strong=("idiot", "moron", "trash"),
    lexicon=(("ths", "this"), ("ou", "you"), ("nd", "and"), (":3", "cat"), ("c++", "cpp"), ("***", "star")),
)
