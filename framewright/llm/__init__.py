"""Operations for large text corpora: filters, duplicate removal, archives, packing."""
