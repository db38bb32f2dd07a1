"""Column functions: small scalar rules used by several operators."""
