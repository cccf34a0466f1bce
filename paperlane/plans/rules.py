"""The rule list: what counts as a kind of personal information, as data.

A rule's ``hints`` are lower-case strings of which any match must hold one; the compiler looks for them first,
because a plain substring search costs far less than a case-blind regular expression. Its ``openings`` are lower-case
strings of which one stands at the beginning of a word in any match; those of all rules are looked for in one pass. A
rule has one or the other. They never change a result.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass, field
from pathlib import Path

METHODS = ("regex", "keyword", "name", "address", "money", "ssn", "labeled_value")


@dataclass(frozen=True)
class Rule:
    key: str
    label: str
    category: str = ""
    method: str = "regex"
    patterns: tuple[str, ...] = ()
    label_pattern: str | None = None
    value_pattern: str | None = None
    window: int = 35
    min_digits: int = 0
    per_person: bool = False
    luhn: bool = False
    casefold: bool = False
    weak: bool = False
    hints: tuple[str, ...] = ()
    openings: tuple[str, ...] = ()

    @classmethod
    def of(cls, raw: dict) -> Rule:
        method = raw.get("method", "regex")
        known = {k: raw[k] for k in cls.__dataclass_fields__ if k in raw}
        known |= {"label": raw.get("label", raw["key"]), "method": method, "weak": raw.get("weak", method == "keyword")}
        known |= {k: tuple(known.get(k) or ()) for k in ("patterns", "hints", "openings")}
        return cls(**known)


@dataclass(frozen=True)
class RuleList:
    name: str = "default"
    version: str = "2.3"
    bde_threshold: int = 51
    bucket_edges: tuple[int, ...] = (10, 20, 50, 100)
    rules: tuple[Rule, ...] = field(default_factory=lambda: DEFAULT_RULES)
    #: Findings as RE2 has them, without look-around: a labelled value's window and a phone number's neighbours are taken with the match, so
    #: nothing begins in them, and a vertical tab is no space. The queries that are held against SQL read so; a run over files does not.
    as_re2: bool = False

    @property
    def per_person(self) -> list[str]:
        return [r.key for r in self.rules if r.per_person]

    @property
    def value_keys(self) -> list[str]:
        return [r.key for r in self.rules if not r.weak]

    def fingerprint(self) -> str:
        """sha256 of the rules as JSON; equal lists have equal fingerprints."""
        values = {k: v for k, v in asdict(self).items() if k != "as_re2" or v}
        return hashlib.sha256(json.dumps(values, sort_keys=True).encode()).hexdigest()


def _k(key: str, label: str, category: str, openings: str, *patterns: str) -> Rule:
    return Rule(key, label, category, "keyword", patterns, weak=True, openings=tuple(openings.split("|")))


def _v(key: str, label: str, category: str, window: int, least: int, hints: str, near: str, value: str) -> Rule:
    return Rule(key, label, category, "labeled_value", label_pattern=near, value_pattern=value, window=window, min_digits=least, hints=tuple(hints.split("|")))


_CONTACT, _GOV, _FIN = "Contact Information", "Government-Issued Identification", "Financial Account Information"
_ID = r"[A-Za-z0-9][A-Za-z0-9-]{4,16}"

# Keys, labels, categories, patterns, windows and flags of the built-in list, in its order.
DEFAULT_RULES: tuple[Rule, ...] = (
    Rule("NAME", "Name", "", "name", per_person=True, weak=True),
    Rule("ADDRESS", "Address", _CONTACT, "address"),
    Rule("EMAIL", "Email", _CONTACT, "regex", (r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b",), per_person=True, casefold=True, hints=("@",)),
    Rule("PHONE", "Phone", _CONTACT, "regex", (r"(?<!\d)(?:\+?1[-.\s]?)?(?:\(\d{3}\)|\d{3})[-.\s]?\d{3}[-.\s]?\d{4}(?!\d)",), per_person=True),
    Rule("SSN", "SSN", _GOV, "ssn", per_person=True),
    _v("PASSPORT", "Passport", _GOV, 30, 4, "passport", r"passport(?:\s*(?:no\.?|number|num|#))?", _ID),
    _v("DRIVER_LICENSE", "Driver License", _GOV, 30, 4, "driver|dl", r"driver'?s?\s*licen[sc]e(?:\s*(?:no\.?|number|#))?|\bdl\s*(?:no\.?|number|#)", _ID),
    _v("TIN", "Tax ID", _GOV, 25, 9, "tax|tin", r"taxpayer\s*id(?:entification)?(?:\s*(?:no\.?|number))?|\btin\b|tax\s*id(?:entification)?(?:\s*(?:no\.?|number))?", r"\d{2}-?\d{7}|\d{9}"),
    _v("NATIONAL_ID", "National/NI Number", _GOV, 25, 6, "national|nino|social", r"national\s*(?:insurance|id)(?:\s*(?:no\.?|number|#))?|\bnino\b|social\s*insurance(?:\s*(?:no\.?|number))?", r"[A-Z]{2}\d{6}[A-D]|[A-Za-z0-9-]{6,12}"),
    _k("ALIEN_REG", "Alien Registration", _GOV, "alien registration|anumber|a-number|uscis", r"\b(?:alien registration|a-?number|uscis)\b"),
    _k("MILITARY_ID", "Military ID", _GOV, "military id|dod id|service number", r"\b(?:military id|\bdod id\b|service number)\b"),
    _k("TRIBAL_ID", "Tribal ID", _GOV, "tribal id", r"\btribal id\b"),
    _v("DOB", "Date of Birth", "Birth Information", 25, 0, "birth|born|dob|do.b|d.ob|d.o.b", r"date\s*of\s*birth|d\.?o\.?b\.?|born(?:\s*on)?|birth\s*date", r"\d{1,2}[/-]\d{1,2}[/-]\d{2,4}|(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\.?\s+\d{1,2},?\s+\d{4}"),
    _k("BIRTH_CERT", "Birth Certificate", "Birth Information", "birth certificate", r"\bbirth certificate\b"),
    Rule("CARD", "Payment Card", _FIN, "regex", (r"\b(?:\d[ -]?){13,19}\b",), per_person=True, luhn=True),
    _v("BANK_ACCOUNT", "Bank/Account Number", _FIN, 30, 6, "account|iban|routing|sort|loan", r"account\s*(?:no\.?|number|#)|\biban\b|routing\s*(?:no\.?|number)?|sort\s*code|loan\s*(?:no\.?|number)", r"[A-Z]{2}\d{2}[A-Z0-9]{10,30}|\d{6,17}"),
    _k("CARD_DETAIL", "Card Expiry/CVV", _FIN, "cvv|cvc|security code|expiration date|exp date|exp. date", r"\b(?:cvv|cvc|security code|expiration date|exp\.? date)\b"),
    _k("CARD_REF", "Card/Transaction", _FIN, "amex|american express|mastercard|master|credit card|debit card|card ending|card number", r"\b(?:amex|american express|master\s?card|credit card|debit card|card ending|card number)\b"),
    _k("FIN_BALANCE", "Account Balance", _FIN, "account balance|available balance", r"\b(?:account balance|available balance)\b"),
    Rule("MONEY", "Money/Amount", _FIN, "money", weak=True),
    _k("CREDENTIALS", "Credentials", "Access Credentials", "password|security question|security answer|pin", r"\bpassword\b", r"\b(?:security question|security answer)\b", r"\bpin\s*(?:number|code|:)\b"),
    _k("HEALTH", "Health", "Health-Related Information", "diagnos|medical history|mental or physical|treatment|prescription|patient|symptom|insurance policy|policy number|subscriber id|claim number|health insurance", r"\b(?:diagnos\w*|medical history|mental or physical|treatment|prescription|patient|symptom)\b", r"\b(?:insurance policy|policy number|subscriber id|claim number|health insurance)\b"),
    _k("BIOMETRIC", "Biometric", "Biometric Data", "fingerprint|voice|genetic print|retina|iris|dna profile", r"\b(?:fingerprint|voice ?print|genetic print|retina|iris (?:scan|image)|dna profile)\b"),
    _k("FAMILY", "Family", "Family Information", "maiden name|marriage certificate", r"\b(?:mother'?s maiden name|maiden name|marriage certificate)\b"),
    _k("DEMOGRAPHIC", "Demographic", "Demographic Information", "raceethnicity|ethnicity|sexual orientation|religio|criminal conviction|trade union", r"\b(?:race/?ethnicity|ethnicity|sexual orientation|religion|religious|criminal conviction|trade union)\b"),
    _k("STUDENT_ID", "Student ID", "Student-Related Information", "student id", r"\bstudent id\b", r"\bstudent identification\b"),
    _k("WORK", "Work-Related", "Work-Related Information", "employee id|employee number|salary|compensation|disciplinary|performance evaluation|worker|employment application", r"\b(?:employee id|employee number|salary|compensation|disciplinary|performance evaluation|workers'? comp|employment application)\b"),
)


def from_dict(raw: dict | None) -> RuleList:
    """A rule list laid over the default one; given entities replace the whole default list."""
    raw = dict(raw or {})
    if "entities" not in raw and ("patterns" in raw or "keywords" in raw):
        raw["entities"] = _older_form(raw)
    out = {k: raw[k] for k in ("name", "version", "bde_threshold") if k in raw}
    if raw.get("bucket_edges"):
        out["bucket_edges"] = tuple(raw["bucket_edges"])
    if "entities" in raw:
        out["rules"] = tuple(Rule.of(e) for e in raw["entities"])
    return RuleList(**out)


def _older_form(raw: dict) -> list[dict]:
    people, checked = raw.get("per_person_types", ()), raw.get("luhn_types", ())
    found = [{"key": k, "label": k.title(), "patterns": [p], "per_person": k in people, "luhn": k in checked, "casefold": k == "EMAIL"} for k, p in raw.get("patterns", {}).items()]
    return found + [{"key": k, "label": k.title(), "method": "keyword", "patterns": [p]} for k, p in raw.get("keywords", {}).items()]


def load(path: str | None = None) -> RuleList:
    """The default list, or one from a JSON or YAML file."""
    if not path:
        return RuleList()
    text = Path(path).read_text(encoding="utf-8")
    if path.lower().endswith((".yaml", ".yml")):
        import yaml

        return from_dict(yaml.safe_load(text))
    return from_dict(json.loads(text))
