"""Training-data operators: scans, filters, de-duplication, packing, output.

Nothing else in the library imports this package.
"""
