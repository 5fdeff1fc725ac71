"""pairpulse: coded news events in, a monthly country-pair unrest index out.

Each layer is a pure ``DataFrame -> DataFrame`` function (``operators``); reading
landed files (``sources``), publishing tables (``sinks``) and date-parameterised jobs
(``plans``, ``streaming``) sit around them.
"""

from pairpulse.config import EngineConfig

__all__ = ["EngineConfig"]
