"""cartwheel: weekly customer–product analytics as Spark DataFrame operators."""
