"""All settings, with the defaults of the Korean instruction corpora this engine was made for.

Patterns are Java regular expressions; where they use \\s or \\d, Unicode counts.
"""

from __future__ import annotations

from dataclasses import dataclass, field, fields
from typing import Any

# Courtesy phrases that are removed, in this order.
COURTESIES = (
    r"안녕하세요[.\s]*",
    r"업무에 고생이 많으십니다[.\s]*",
    r"평소 시정에 관심을 갖고 건의하여 주심에 감사드립니다[.\s]*",
    r"감사합니다[.\s]*$",
)
# Task names.
SUMMARY, QUESTIONS, CLASSIFICATION = "요약", "질의응답", "분류"
# Fixed value: the system message of chat rows.
SYSTEM_PROMPT = "당신은 사용자의 지시를 이해하고 적절한 형식으로 한국어 응답을 생성하는 도우미이다."


@dataclass(frozen=True)
class Cleaning:
    normalize_unicode: bool = True
    remove_control_chars: bool = True
    strip_html_tags: bool = True
    remove_courtesies: bool = True
    courtesies: tuple[str, ...] = COURTESIES
    normalize_whitespace: bool = True
    #: Most newlines in a row; 0: any number.
    most_newlines: int = 2
    strip_leading_numbering: bool = False


@dataclass(frozen=True)
class PersonalData:
    mask_leak_name: bool = True
    phone: bool = True
    email: bool = True
    rrn: bool = True
    account: bool = True
    address_detail: bool = True
    #: flag: note findings; mask: replace them by token; drop: leave out rows with any.
    action: str = "flag"
    token: str = "[PII]"

    def __post_init__(self) -> None:
        if self.action not in ("flag", "mask", "drop"):
            raise ValueError(f"action must be flag, mask or drop, not {self.action!r}")


@dataclass(frozen=True)
class Quality:
    drop_empty_fields: bool = True
    min_instruction: int = 5
    min_input: int = 20
    min_output: int = 5
    max_input: int = 10_000
    max_output: int = 5_000
    min_output_words: int = 2
    drop_input_equals_output: bool = True
    #: Largest share of one sentence among an output's sentences; 0: any.
    max_repetition: float = 0.5
    #: Tasks with short answers, and their own minimums.
    short_answer_tasks: tuple[str, ...] = (QUESTIONS, CLASSIFICATION)
    short_min_output: int = 1
    short_min_output_words: int = 1


@dataclass(frozen=True)
class Dedup:
    exact: bool = True
    near: bool = True
    threshold: float = 0.85
    ngram: int = 5
    permutations: int = 128
    key: str = "instruction_output"
    #: Tasks that only lose exact copies, by a key of their own.
    exact_only_tasks: tuple[str, ...] = (CLASSIFICATION,)
    exact_only_key: str = "input_output"


@dataclass(frozen=True)
class Output:
    #: alpaca: a JSON array; jsonl: a row a line.
    format: str = "alpaca"
    metadata: bool = True

    def __post_init__(self) -> None:
        if self.format not in ("alpaca", "jsonl"):
            raise ValueError(f"format must be alpaca or jsonl, not {self.format!r}")


@dataclass(frozen=True)
class Settings:
    train_dir: str = "./raw_data/Training"
    val_dir: str = "./raw_data/Validation"
    output_dir: str = "./processed_data"
    report_dir: str = "./reports"
    cleaning: Cleaning = field(default_factory=Cleaning)
    personal_data: PersonalData = field(default_factory=PersonalData)
    quality: Quality = field(default_factory=Quality)
    dedup: Dedup = field(default_factory=Dedup)
    output: Output = field(default_factory=Output)
    log_level: str = "INFO"
    log_file: str | None = "pipeline.log"

    @classmethod
    def of(cls, values: dict[str, Any]) -> Settings:
        """Settings from nested dicts, as from a JSON file; unknown names are refused."""
        groups = {"cleaning": Cleaning, "personal_data": PersonalData, "quality": Quality, "dedup": Dedup, "output": Output}
        known = {f.name for f in fields(cls)}
        if unknown := set(values) - known:
            raise ValueError(f"unknown settings: {sorted(unknown)}")
        made = {}
        for name, value in values.items():
            if name in groups:
                value = groups[name](**{k: tuple(v) if isinstance(v, list) else v for k, v in value.items()})
            made[name] = value
        return cls(**made)
