"""layerkit: layered (raw / cleaned / modelled) data pipelines on Spark.

Every operator takes and returns DataFrames or Columns and is written with
Spark SQL functions, so Catalyst plans it and whole-stage codegen runs it.
No operator collects data rows to the driver; the only driver-side values are
single aggregates (a watermark, a count used as a size check) and parameters.
"""

__version__ = "0.1.0"
