"""Settings of a run, with their defaults."""

from __future__ import annotations

from dataclasses import dataclass, field

from .rules import RuleList


@dataclass(frozen=True)
class Settings:
    rules: RuleList = field(default_factory=RuleList)
    bde_threshold: int = 51
    structured_review_rows: int = 0  # 0: the BDE threshold
    bde_count_floor: int = 7  # the person counter runs at this estimate or more
    unreadable_bytes: int = 6000  # a structured file above this size with nothing read is not cleared
    confirm_heuristic_bde: bool = True  # False: an estimate alone leaves a file clearable by the model
    use_stage2: bool = True
    stage2_on_all: bool = False
    s2_bde_threshold: int = 0  # 0: the BDE threshold
    max_bytes: int = 1 << 30
    max_scan_chars: int = 5_000_000
    max_scan_rows: int = 200_000
    sample_rows: int = 50
    zip_ratio_limit: int = 200
    timeout_s: float = 150  # of a file's parser, which is killed then
    parser_memory_mb: int = 4096  # what a file's parser may take beside the worker; 0: no limit
    pdf_open_timeout_s: float = 30.0
    pdf_max_pages: int = 0  # pages of a PDF that are read for text; 0: all
    pdf_probe_pages: int = 0  # after so many pages of little text a PDF is tested for being a scan; 0: at its end
    protocol_text: str = ""  # the matter's own rules, for the model; its first 8,000 characters are sent
    llm_input_chars: int = 24_000
    price_per_1k_in: float = 0.0
    price_per_1k_out: float = 0.0
    price_per_1k_pages: float = 0.0
