"""Operators that prepare training data.  Nothing else in the library imports this subpackage."""

from .register import ORACLES, QUERIES  # noqa: F401
from . import alignment, decontaminate, langid, licenses, minhash, mixing, partenum, pii, quality, substring, suffix, toxicity, whitening  # noqa: F401,E402
