"""DataFrame operators on pixel, label and metadata relations."""
