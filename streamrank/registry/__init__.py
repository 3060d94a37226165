"""Named queries over the test tables, with the SQL that checks them."""

from .batch import BATCH
from .delivered import DELIVERED
from .oracles import ORACLES
from .streamed import STREAMED

QUERIES = {**BATCH, **DELIVERED, **STREAMED}

__all__ = ["ORACLES", "QUERIES"]
