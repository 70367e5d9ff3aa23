"""remitflow — supplier-payment disbursement jobs expressed as Spark DataFrame plans.

Payments are selected per request (one request = one output file), rendered into
bank files whose layout is data, reported in a localised register and moved
through an append-only status log.  Everything is lazy DataFrame/SQL; the only
driver-side work is compiling small, size-checked metadata (formats, masks,
flexfield segments) into Column expressions.
"""

__all__ = ["schema", "session"]
