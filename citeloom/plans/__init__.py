"""citeloom.plans"""
