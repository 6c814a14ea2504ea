"""Training-data operators: one module per operator, registered in ``queries``."""
