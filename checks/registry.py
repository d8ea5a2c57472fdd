"""All registered queries."""

from . import classify, exports, overlays, recommend, training

MODULES = [recommend, classify, overlays, training, exports]
QUERIES = {name: fn for m in MODULES for name, fn in m.QUERIES.items()}
ORACLE = {name: sql for m in MODULES for name, sql in m.ORACLE.items()}
