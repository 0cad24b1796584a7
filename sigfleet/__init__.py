"""sigfleet: fleet-wide equipment telemetry on Spark.

Landed signal payloads and equipment catalogues become typed DataFrames
(``pumps``, ``readings``, ``fetch_outcomes``); the operators in
``sigfleet.operators`` answer range, latest-value, bundle, report and
export questions for the whole fleet with plain DataFrame operations.
"""

__version__ = "0.1.0"
