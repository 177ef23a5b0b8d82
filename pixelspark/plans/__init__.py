"""The workflow of a screening study, composed of operators."""
