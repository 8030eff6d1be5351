"""recordloom.plans"""
