"""Table scans with declared schemas, adapters to the e-commerce shape, format I/O, layouts."""
