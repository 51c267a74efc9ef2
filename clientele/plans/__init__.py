"""The reports and lists the library exists for, one module per subject."""
