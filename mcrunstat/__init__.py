"""mcrunstat: Monte Carlo run results analytics as lazy Spark DataFrame operators.

Layout: ``sources`` (scans, catalog jobs, sinks, fixture views), ``functions``
(Column expressions: bands, labels, predicates), ``operators`` (DataFrame ->
DataFrame steps), ``plans`` (products and the registered queries).
"""

__version__ = "0.1.0"
