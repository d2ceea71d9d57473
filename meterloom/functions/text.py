"""Text expressions: identities, names, folders, forbidden keys."""

from pyspark.sql import Column, functions as F

from meterloom.fixed_values import (HOME_PATTERN, HOME_REPO_PATTERN, MACHINE_PATTERN, PERCENT_KEY_WORDS, RESERVED_SESSION,
                                    SCHEDULED_PATTERN, SCRATCH_REPO_PATTERN, SESSION_PATTERN)

# One JSON string token, then the colon that makes it a key. Possessive, so a long text neither backtracks nor recurses.
_STRING_TOKEN = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"\s*:?'


def row_hash(raw: Column, key: Column | None = None) -> Column:
    return F.sha1(F.concat(key if key is not None else F.lit(""), F.lit("\n"), raw))


def blank_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def is_all(text: Column, pattern: str) -> Column:
    """Whether a pattern takes in the whole text; `$` would let a final line feed pass."""
    return text.rlike(rf"^(?:{pattern})\z")


def valid_session(session: Column) -> Column:
    return F.coalesce(is_all(session, SESSION_PATTERN) & (session != RESERVED_SESSION), F.lit(False))


def session_or_null(session: Column) -> Column:
    return F.when(valid_session(session), session)


def valid_machine(machine: Column) -> Column:
    return F.coalesce(is_all(machine, MACHINE_PATTERN), F.lit(False))


def has_percent_key(raw: Column) -> Column:
    """Whether a JSON text holds, at any depth, a key that names a quota percent. Strings are read token by token, so
    a quoted text inside a value is no key; the cheap search first spares nearly every row the tokenising. A text with
    escaped letters is written anew first, as its keys may spell a word with them."""
    raw = F.when(raw.contains("\\u"), F.coalesce(canonical_json(raw), raw)).otherwise(raw)
    seen = raw.rlike(f"(?i){PERCENT_KEY_WORDS}")
    found = F.regexp_extract_all(raw, F.lit(_STRING_TOKEN), F.lit(0))
    return F.coalesce(F.when(seen, F.exists(found, lambda t: t.endswith(":") & t.rlike(f"(?i){PERCENT_KEY_WORDS}")))
                      .otherwise(F.lit(False)), F.lit(False))


def project(folder: Column) -> Column:
    """A folder reduced to its repository; '~…' under a home, '?' when unknown."""
    repo = F.regexp_extract(folder, HOME_REPO_PATTERN, 1)
    scratch = F.regexp_extract(folder, SCRATCH_REPO_PATTERN, 1)
    return (F.when(F.coalesce(folder, F.lit("")) == "", F.lit("?"))
            .when(repo != "", repo)
            .when(folder.rlike(HOME_PATTERN), F.concat(F.lit("~"), F.regexp_extract(folder, HOME_PATTERN, 1)))
            .when(scratch != "", scratch)
            .otherwise(folder))


def kind_of_use(folder: Column, entrypoint: Column) -> Column:
    return (F.when(F.coalesce(entrypoint, F.lit("")) == "", F.lit("?"))
            .when(~entrypoint.startswith("sdk"), F.lit("development"))
            .when(F.coalesce(folder, F.lit("")).rlike(SCHEDULED_PATTERN), F.lit("scheduled run"))
            .otherwise(F.lit("test run")))


def canonical_json(text: Column) -> Column:
    """JSON text with object keys in one order, for comparing structures (a VARIANT stores keys sorted)."""
    return F.to_json(F.try_parse_json(text))
