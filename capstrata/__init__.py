"""Image-caption and text curation on Spark: filters, duplicate removal, scoring, augmentation and corpus operators."""
