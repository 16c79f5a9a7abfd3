from vertexloom.functions.columns import csv_field, default_weight, first_value, strict_cast

__all__ = ["csv_field", "default_weight", "first_value", "strict_cast"]
