"""claimweave: follow what people claim in recorded conversations, as Spark jobs.

Every operator takes DataFrames and returns DataFrames.  Searches, groups, trees and
kept answers run Spark jobs while the plan is built, as they write intermediate
results (``session.durable``) or need a stopping test; so do the writers in
``sources`` and ``streaming``.  Everything else is lazy.
"""

from claimweave.params import Params

__all__ = ["Params"]
