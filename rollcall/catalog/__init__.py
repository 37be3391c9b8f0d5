from rollcall.catalog.oracles import ORACLES
from rollcall.catalog.queries import QUERIES

__all__ = ["ORACLES", "QUERIES"]
