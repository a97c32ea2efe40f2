"""ledgerwalk: commerce marts (margin walk, delivery, discount, cohorts, payback,
returns) expressed as distributed Spark DataFrame plans."""

__version__ = "0.1.0"
