"""martworks: PySpark operators for loading raw feeds into analytic tables and marts.

Subpackages: ``sources`` (readers), ``sinks`` (writers and in-place merges),
``functions`` (column and aggregate expressions), ``operators`` (DataFrame -> DataFrame
transforms, merges, joins, quantile trim, top-n, quality gates), ``plans`` (marts,
end-to-end jobs, synthetic collections, registered queries) and ``streaming`` (the
file-stream load).
"""

__version__ = "0.1.0"
